"""Language-model scores by Katz backoff, learned from one part of a corpus, for all of it.

The model is of bigrams over words and the end of a text, which counts as a word; the first word
follows a start mark that is never predicted. Counts up to ``TOP`` are discounted by Good and
Turing's estimate from the numbers of n-grams that occur once, twice ... A word seen after its
context takes its discounted share of the context. What a context's words leave goes to all
others in proportion to their chance without context: the backoff weight is that rest divided
by the lower-order chances of the words not seen after it, so each context's chances add to 1.
Words without context are recursed to in the same way: known ones take their discounted shares
and the rest is dealt evenly to the unseen ones, whose number is Chao's estimate from the words
that occur once and twice. A context whose words all keep their whole counts would leave nothing
and is counted once more. Where the counts of counts give no discounts between 0 and 1 up to
``TOP``, they are taken up to the largest count that does; if none does, r words count as
r - 1/2.

On Spark:

1. Tasks cut texts into batches, number each batch's distinct words and write its tokens as such
   numbers to a file of the shared folder. Its words go, with their training counts, to the
   task that their key falls to, which adds up the unigram table and answers each batch with its
   words' totals.
2. Each batch's distinct bigrams go to the task of their context. A context that holds more than
   one task's share of all tokens is dealt to as many tasks as it has shares, by the second word.
   The tasks add up the bigram table and answer with each bigram's total and, for contexts that
   have to back off in the batch, what their weight is made of. Parts of dealt contexts, fewer
   than twice the tasks, are added up by Spark.
3. Batches are scored from the answers, token by token: seen bigram, else weight times unigram.

So a bigram or word travels once for each batch it occurs in, never for each document, and every
step groups by a number of tasks that the session sets (``spark.sql.shuffle.partitions``). Both
tables are stored by partition (``Model``). Words are known by a 64-bit key: among 10^9 different
ones two share a key with a chance of 3 %. Steps 1 and 2 are stored as Parquet, batch files
never change, and all else is worked out from these, so lost executors cost a rerun of their tasks.

Null, empty and blank texts have one token, the end. A null id is scored like others; whether a
row teaches is the caller's column, null meaning no. Repeated rows each count. Very long texts are
read whole and make a batch of their own. Without training texts every word is the one unseen
word, of chance 1. Columns beyond id and text are not touched, whatever their names. An
empty table gives no rows.
"""
from __future__ import annotations

import itertools
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.packing import pack, steps, sums, unpack
from quarterline.llm.words import SLICE
from quarterline.plans.lineage import materialise, new_path

TOP = 5
BATCH_BYTES = 1 << 24
END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds white space
START = 2**64 - 1
RS = np.arange(TOP + 1)

ANSWER = "kind string, part int, task int, batch string, blob binary, total long, types long, " + ", ".join(f"n{r} long" for r in range(1, TOP + 2))
PART = "key decimal(20,0), reaches double, " + ", ".join(f"n{r} long" for r in range(1, TOP + 1))


@dataclass(frozen=True)
class Discounts:
    """Of one order: the share of its count that an n-gram of each count up to ``TOP`` keeps."""
    total: int
    types: int
    kept: np.ndarray
    up_to: int

    def mass(self, count: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return count * np.where(count <= TOP, self.kept[np.minimum(count, TOP)], 1.0)

    def left(self, small: np.ndarray) -> np.ndarray:
        """What n-grams of small counts leave; ``small`` has the numbers of those of 1, 2 ..."""
        return (small * ((1.0 - self.kept) * RS)[1:]).sum(-1)


def discounts(total: int, types: int, n: list[int]) -> Discounts:
    """``n``: how many n-grams occur once, twice ... ``TOP`` + 1 times."""
    n = [0, *n]
    for top in range(TOP, 0, -1):
        if not all(n[1:top + 2]):
            continue
        over = (top + 1) * n[top + 1] / n[1]
        if over >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over) for r in range(1, top + 1)]
        if all(0 < x < 1 for x in d):
            return Discounts(total, types, np.array([1.0, *d, *[1.0] * (TOP - top)]), top)
    return Discounts(total, types, np.array([1.0, *((r - 0.5) / r for r in range(1, TOP + 1))]), TOP)


class Unigrams:
    """Chances of words without context."""

    def __init__(self, d: Discounts, n: list[int]):
        self.d = d
        small = np.array(n[:TOP])
        rest = float(d.left(small))
        whole = d.total if rest > 0 else d.total + 1
        self.share = 1.0 / whole
        # unseen words, by Chao's estimate from those seen once and twice
        self.unseen = (rest if rest > 0 else 1.0) / whole / (1 + n[0] * (n[0] - 1) // (2 * (n[1] + 1)))

    def chance(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.d.mass(count) * self.share, self.unseen)


@dataclass(frozen=True)
class Model:
    """The stored tables, a row of packed arrays for each part, and their discounts.

    ``unigrams``: keys (differences) and counts. ``bigrams``: contexts (differences), words of each,
    second words' keys (differences), their places, counts."""
    unigrams: DataFrame
    bigrams: DataFrame
    words: Unigrams
    pairs: Discounts


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _words(text: bytes):
    """Words in lower case, some at a time."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end].lower().split()
        at = end


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _write_batch(folder: str, ids: pa.Array, texts: list[bytes], taught: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """Write a batch's file; its path, the keys of its words and their training counts."""
    numbers = _Numbers()
    end = numbers[b"\n"]
    own = []
    for t in texts:
        found = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in _words(t)]
        own.append(np.concatenate([*found, [end]]).astype(np.int32))
    keys = np.fromiter((min(xxhash.xxh3_64_intdigest(w), START - 1) for w in numbers), np.uint64, len(numbers))
    keys, number = np.unique(keys, return_inverse=True)
    sizes = np.array([len(x) for x in own])
    tokens = number[np.concatenate(own)]
    counts = np.bincount(tokens, weights=np.repeat(taught, sizes), minlength=len(keys)).astype(np.int64)
    path = f"{folder}/{uuid.uuid4().hex}.batch"
    store, inner = fs.FileSystem.from_uri(path)
    table = pa.table({"id": ids, "taught": pa.array(taught), "size": pa.array(sizes)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    rows, blob = sink.getvalue().to_pybytes(), pack(steps(keys), tokens)
    with store.open_output_stream(inner) as out:
        out.write(len(blob).to_bytes(8, "little") + blob + rows)
    return path, keys, counts


class _Batch:
    """A batch as it was written, with its distinct bigrams by part, context and second word."""

    def __init__(self, path: str):
        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_stream(inner) as f:
            data = f.read()
        size = int.from_bytes(data[:8], "little")
        keys, tokens = unpack(data[8:8 + size])
        self.rows = pa.ipc.open_stream(data[8 + size:]).read_all()
        self.keys = np.append(sums(keys), np.uint64(START))
        self.tokens = tokens.astype(np.int64)
        self.sizes = self.rows["size"].to_numpy()
        self.taught = self.rows["taught"].to_numpy(zero_copy_only=False)

    def pairs(self, count: np.ndarray, total: int, parts: int) -> None:
        """Find the bigrams, given the totals of the batch's words and of all."""
        n = len(self.keys) - 1
        end = int(np.searchsorted(self.keys, np.uint64(min(END, START - 1))))
        self.count = count
        self.follows = np.append(count, count[end])  # a text's start is followed as often as there are ends
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = n
        code, place = np.unique(before * (n + 1) + self.tokens, return_inverse=True)
        trained = np.bincount(place, weights=np.repeat(self.taught, self.sizes), minlength=len(code)).astype(np.int64)
        context, word = np.divmod(code, n + 1)
        shares = 1 + np.maximum(self.follows * parts - 1, 0) // max(total, 1)  # by whole shares of a part
        part = _part(self.keys, parts)[context]
        dealt = shares > 1
        on = np.flatnonzero(dealt[context])
        part[on] = (part[on] + (self.keys[word[on]] % shares[context[on]].astype(np.uint64)).astype(np.int64)) % parts
        order = np.argsort(part, kind="stable")
        self.place = np.empty_like(order)
        self.place[order] = np.arange(len(order))
        self.place = self.place[place]
        self.context, self.word, self.part, self.trained, self.dealt = context[order], word[order], part[order], trained[order], dealt

    def by_part(self):
        """For each part its number, its bigrams and the first one of each context."""
        bounds = np.flatnonzero(np.r_[True, self.part[1:] != self.part[:-1], True]) if len(self.part) else [0]
        for a, b in itertools.pairwise(bounds):
            context = self.context[a:b]
            yield int(self.part[a]), slice(a, b), a + np.flatnonzero(np.r_[True, context[1:] != context[:-1]])


def _grouped(batches, *by: str):
    """Runs of rows that agree in ``by``, as dicts of lists; rows come sorted by it."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, group in itertools.groupby(rows, key=lambda r: tuple(r[c] for c in by)):
        yield key, list(group)


class _Rows:
    """Rows of a schema, some at a time."""

    def __init__(self, schema: str):
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "decimal(20,0)": pa.decimal128(20, 0)}
        self.schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def __call__(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, self.schema)


def _cut(docs: DataFrame, folder: str, parts: int) -> DataFrame:
    """Step 1, first half: batch files and, by part, the words of each."""
    schema = "part int, task int, batch string, blob binary"

    def run(batches):
        task, make = TaskContext.get().partitionId(), _Rows(schema)
        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner, recursive=True)

        def rows(held):
            ids = pa.concat_arrays([h[0] for h in held])
            path, keys, counts = _write_batch(folder, ids, [t for h in held for t in h[1]], np.array([x for h in held for x in h[2]], bool))
            part = _part(keys, parts)
            bounds = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            return make([{"part": int(part[a]), "task": task, "batch": path, "blob": pack(steps(keys[a:b]), counts[a:b])} for a, b in itertools.pairwise(bounds)])

        held, size = [], 0
        for b in batches:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            taught = [bool(x) for x in b.column(2).to_pylist()]
            at = 0
            for k, t in enumerate(texts):
                if size and size + len(t) > BATCH_BYTES:
                    held.append((b.column(0).slice(at, k - at), texts[at:k], taught[at:k]))
                    yield rows(held)
                    held, size, at = [], 0, k
                size += len(t) + 1
            held.append((b.column(0).slice(at), texts[at:], taught[at:]))
        if size:
            yield rows(held)

    return materialise(docs.mapInArrow(run, schema), "katz_words")


def _to_parts(df: DataFrame, parts: int) -> DataFrame:
    return df.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "batch")


def _to_tasks(df: DataFrame, parts: int) -> DataFrame:
    """All rows of a batch in one task; a task's batches stay together."""
    return df.repartitionById(parts, F.col("task")).sortWithinPartitions("batch", "kind", "part")


def _small(counts: np.ndarray) -> dict[str, int]:
    n = np.bincount(np.minimum(counts, TOP + 2), minlength=TOP + 3)
    return {f"n{r}": int(n[r]) for r in range(1, TOP + 2)}


def _add_words(words: DataFrame, parts: int) -> DataFrame:
    """Step 1, second half: unigram totals, and each batch's words' totals as answers."""
    def run(batches):
        make = _Rows(ANSWER)
        for (part,), rows in _grouped(batches, "part"):
            asked = [unpack(r["blob"]) for r in rows]
            asked = [(sums(k), c) for k, c in asked]
            keys, place = np.unique(np.concatenate([k for k, _ in asked]), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate([c for _, c in asked]), minlength=len(keys)).astype(np.int64)
            seen = total > 0
            yield make([{"kind": "table", "part": part, "blob": pack(steps(keys[seen]), total[seen]), "total": int(total.sum()),
                         "types": int(seen.sum()), **_small(total)}])
            at = 0
            for r, (k, _) in zip(rows, asked):
                yield make([{**r, "kind": "1", "blob": pack(total[place[at:at + len(k)]])}])
                at += len(k)

    return materialise(_to_parts(words, parts).mapInArrow(run, ANSWER), "katz_unigrams")


def _counts_of_counts(answers: DataFrame) -> tuple[int, int, list[int]]:
    names = [f"n{r}" for r in range(1, TOP + 2)]
    row = answers.where("kind = 'table'").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "types", *names))).first()
    return row["total"], row["types"], [row[c] for c in names]


def _ask_pairs(answers: DataFrame, parts: int, total: int) -> DataFrame:
    """Step 2, first half: by part, the bigrams of each batch."""
    schema = "part int, task int, batch string, blob binary"

    def run(batches):
        make = _Rows(schema)
        for (path,), rows in _grouped(batches, "batch"):
            b = _Batch(path)
            b.pairs(np.concatenate([unpack(r["blob"])[0] for r in rows]).astype(np.int64), total, parts)
            for part, at, firsts in b.by_part():
                context = b.context[firsts]
                second, place = np.unique(b.word[at], return_inverse=True)
                blob = pack(steps(b.keys[context]), np.diff(np.r_[firsts, at.stop]), b.dealt[context].astype(np.uint8),
                            steps(b.keys[second]), b.count[second], place, b.trained[at])
                yield make([{"part": part, "task": rows[0]["task"], "batch": path, "blob": blob}])

    return _to_tasks(answers.where("kind = '1'"), parts).mapInArrow(run, schema)


def _sum_by(owner: np.ndarray, values: np.ndarray | None, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def _add_pairs(asked: DataFrame, parts: int, words: Unigrams) -> DataFrame:
    """Step 2, second half: bigram totals, answers, and the parts of contexts that are dealt out."""
    schema = ANSWER + ", " + PART.replace("n1", "s1").replace("n2", "s2").replace("n3", "s3").replace("n4", "s4").replace("n5", "s5")

    def run(batches):
        make = _Rows(schema)
        for (part,), rows in _grouped(batches, "part"):
            lists = [unpack(r["blob"]) for r in rows]
            lists = [(sums(c), n, d, sums(s), k, p.astype(np.int64), t) for c, n, d, s, k, p, t in lists]
            contexts = np.unique(np.concatenate([x[0] for x in lists]))
            seconds, some = np.unique(np.concatenate([x[3] for x in lists]), return_index=True)
            count = np.concatenate([x[4] for x in lists])[some].astype(np.int64)
            own = [np.searchsorted(contexts, x[0]) for x in lists]
            codes = [np.repeat(o, x[1]) * len(seconds) + np.searchsorted(seconds, x[3])[x[5]] for o, x in zip(own, lists)]
            code, place = np.unique(np.concatenate(codes), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate([x[6] for x in lists]), minlength=len(code)).astype(np.int64)
            context, second = np.divmod(code, len(seconds))
            seen = total > 0
            owner, n = context[seen], len(contexts)
            small = np.stack([_sum_by(owner, total[seen] == r, n) for r in range(1, TOP + 1)], 1).astype(np.int64)
            reaches = _sum_by(owner, words.chance(count[second[seen]]), n)
            sizes = _sum_by(owner, None, n)
            yield make([{"kind": "table", "part": part, "total": int(total.sum()), "types": int(seen.sum()), **_small(total),
                         "blob": pack(steps(contexts[sizes > 0]), sizes[sizes > 0].astype(np.int64), steps(seconds), second[seen], total[seen])}])
            dealt = np.zeros(n, bool)
            for o, x in zip(own, lists):
                dealt[o] |= x[2].astype(bool)
            on = np.flatnonzero(dealt & (sizes > 0)).tolist()
            if on:
                yield make([{"kind": "dealt", "part": part, "key": int(contexts[i]), "reaches": float(reaches[i]),
                             **{f"s{r}": int(small[i, r - 1]) for r in range(1, TOP + 1)}} for i in on])
            least = np.where(small.any(1), (small > 0).argmax(1) + 1, 0)
            at = 0
            for r, o, x, c in zip(rows, own, lists, codes):
                mine = total[place[at:at + len(c)]]
                at += len(c)
                back = _sum_by(np.repeat(np.arange(len(o)), x[1]), mine == 0, len(o)) > 0
                some = o[back]
                yield make([{**r, "kind": "2", "blob": pack(mine, least[o], back.astype(np.uint8), *small[some].T, reaches[some])}])

    return materialise(_to_parts(asked, parts).mapInArrow(run, schema), "katz_bigrams")


def _dealt_contexts(answers: DataFrame) -> dict[int, tuple[np.ndarray, float]]:
    """Contexts that were dealt out, together again: fewer than parts, as each holds a share."""
    rows = answers.where("kind = 'dealt'").groupBy("key").agg(F.sum("reaches").alias("reaches"), *(F.sum(f"s{r}").alias(f"s{r}") for r in range(1, TOP + 1))).collect()
    return {int(r["key"]): (np.array([r[f"s{k}"] for k in range(1, TOP + 1)]), r["reaches"]) for r in rows}


def _score_batch(b: _Batch, answers: list[bytes], words: Unigrams, pairs: Discounts, dealt: dict) -> tuple[np.ndarray, np.ndarray]:
    """The logarithm to base 10 of each bigram's chance, and whether it was backed off."""
    n_pairs, n = len(b.context), len(b.keys)
    seen = np.empty(n_pairs, np.int64)
    least = np.zeros(n, np.int64)
    small, reaches = np.zeros((n, TOP), np.int64), np.zeros(n)
    for (_, at, firsts), blob in zip(b.by_part(), answers, strict=True):
        count, low, back, *numbers, reach = unpack(blob)
        seen[at] = count
        context = b.context[firsts]
        least[context] = low
        some = context[back.astype(bool)]
        small[some], reaches[some] = np.stack(numbers, 1), reach
    for i in np.flatnonzero(b.dealt).tolist():
        found = dealt.get(int(b.keys[i]))
        if found is not None:
            small[i], reaches[i] = found
            least[i] = int((small[i] > 0).argmax()) + 1 if small[i].any() else 0
    context, follows = b.context, b.follows.astype(np.float64)
    # a context whose words keep their whole counts is counted once more
    whole = follows + ((least == 0) | (least > pairs.up_to))
    backed = seen == 0
    chance = np.empty(n_pairs)
    on = np.flatnonzero(~backed)
    chance[on] = np.log10(pairs.mass(seen[on]) / whole[context[on]])
    on = np.flatnonzero(backed)
    c = context[on]
    left = pairs.left(small[c])
    left = np.where((least[c] == 0) | (least[c] > pairs.up_to), 1.0, left) / whole[c]
    weight = np.where(follows[c] > 0, left / (1.0 - reaches[c]), 1.0)
    chance[on] = np.log10(weight) + np.log10(words.chance(b.count[b.word[on]]))
    return chance, backed


def _score(one: DataFrame, two: DataFrame, id: str, kind: str, parts: int, words: Unigrams, pairs: Discounts, dealt: dict) -> DataFrame:
    """Step 3."""
    told = one.sparkSession.sparkContext.broadcast(dealt)
    total, types = words.d.total, words.d.types

    def run(batches):
        for (path,), rows in _grouped(batches, "batch"):
            b = _Batch(path)
            b.pairs(np.concatenate([unpack(r["blob"])[0] for r in rows if r["kind"] == "1"]).astype(np.int64), total, parts)
            chance, backed = _score_batch(b, [r["blob"] for r in rows if r["kind"] == "2"], words, pairs, told.value)
            owner = np.repeat(np.arange(len(b.sizes)), b.sizes)
            n = len(b.sizes)
            known = b.count > 0
            base = np.log10((b.count + 1) / (total + types + 1))
            columns = [b.rows["id"].combine_chunks(), pa.array(b.taught), pa.array(b.sizes), pa.array(_sum_by(owner, known[b.tokens], n).astype(np.int64)),
                       pa.array(_sum_by(owner, backed[b.place], n).astype(np.int64)), pa.array(_sum_by(owner, base[b.tokens], n)), pa.array(_sum_by(owner, chance[b.place], n))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "taught", "n_tokens", "n_known", "n_backed_off", "base_score", "score"])

    answers = one.where("kind = '1'").select("kind", "part", "task", "batch", "blob").unionByName(two.where("kind = '2'").select("kind", "part", "task", "batch", "blob"))
    schema = f"id {kind}, taught boolean, n_tokens long, n_known long, n_backed_off long, base_score double, score double"
    return _to_tasks(answers, parts).mapInArrow(run, schema).withColumnRenamed("id", id).withColumn("train_tokens", F.lit(total).cast("long"))


def score(docs: DataFrame, id: str, text: str, teaches: Column, parts: int | None = None) -> tuple[DataFrame, Model]:
    """Learn from the rows that ``teaches`` holds for and score all.

    The scores have ``id`` as it is named, ``taught``, ``n_tokens``, ``n_known`` (tokens that occur
    in training texts), ``n_backed_off``, ``base_score`` (sum of log10((c + 1)/(N + V + 1))), ``score``
    (the model's log10 chance of the text) and ``train_tokens``."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(teaches, F.lit(False)).alias("taught"))
    one = _add_words(_cut(rows, new_path(spark, "katz_batches"), parts), parts)
    total, types, n = _counts_of_counts(one)
    words = Unigrams(discounts(total, types, n), n)
    two = _add_pairs(_ask_pairs(one, parts, total), parts, words)
    pairs = discounts(*_counts_of_counts(two))
    scores = _score(one, two, id, dict(docs.dtypes)[id], parts, words, pairs, _dealt_contexts(two))
    table = lambda df: df.where("kind = 'table'").select("part", "blob", "total", "types")
    return scores, Model(table(one), table(two), words, pairs)
