"""Secret scans, against the patterns run text by text."""
import hashlib
import random
import re

from pyspark.sql import functions as F

from quarterline.llm import secrets
from quarterline.plans.lineage import new_path


def letters(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(" + "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|" + letters("api") + "_?" + letters("key")
                    + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def spans(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def texts():
    rnd = random.Random(8)
    bits = ["password", "PassWD", "secret", "TOKEN", "api_key", "apikey", "='", " : ", ":", "=", '"', "AKIA", "AKIA" + "Z9" * 7, "0123456789abcdef" * 2,
            "deadbeef", "Xy9+/_.=-", "é", "😀", "\n", " ", "abcdefgh", "token=short", "secret=token: abcdefghij", "ſecret=abcdefgh1"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 14))) for _ in range(400)] + ["x " * 100_000 + "token=abcdefgh1", None, ""]


def test_spans(spark):
    own = texts()
    df = spark.createDataFrame([(i, t, "b", 1) for i, t in enumerate(own)], "doc_id long, text string, blob string, rule int").repartition(3)
    for r in secrets.scan_table(df, "doc_id", "text").collect():
        want = spans(own[r.path])
        assert r.spans == ",".join(s for _, _, s in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in want) for n in range(3))
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()


def test_only_what_is_new_is_scanned(spark):
    ledger = secrets.Ledger(spark, new_path(spark, "ledger"))
    one = spark.createDataFrame([(1, "token=abcdefgh1"), (2, "clean"), (3, "token=abcdefgh1")], "p long, t string")
    two = spark.createDataFrame([(1, "clean"), (4, "AKIA" + "Q" * 16)], "p long, t string")
    first, second = secrets.versions(one, "p", "t"), secrets.versions(two, "p", "t", F.lit(1))
    ledger.scan(first)
    assert ledger.scanned().count() == 2 * 3 and ledger.findings().count() == 1
    ledger.scan(second)
    assert ledger.scanned().count() == 3 * 3 and ledger.findings().count() == 2
    ledger.scan(first)
    assert ledger.scanned().count() == 3 * 3
    # a new version of one rule scans its pairs only
    newer = (*secrets.RULES[:2], secrets.Rule("hex", 2, "[0-9a-f]{16,}", 0, 16))
    ledger.scan(first, newer)
    marks = {r.rule: r["count"] for r in ledger.scanned().groupBy("rule").count().collect()}
    assert marks == {"assign-1": 3, "access-1": 3, "hex-1": 3, "hex-2": 2}
    # findings of a run that did not come to its end don't count
    spark.createDataFrame([("b", "hex-1", 0, 40, "lost")], secrets.FINDING + ", run string").write.mode("append").parquet(f"{ledger.folder}/findings")
    assert ledger.findings().count() == 2
    got = {(r.path, r.version): r.spans for r in secrets.report(first.unionByName(second), ledger.findings()).collect()}
    assert got == {(1, 0): "assign:0:15", (2, 0): "", (3, 0): "assign:0:15", (1, 1): "", (4, 1): "access:0:20"}


def masked(text):
    if text is None or not spans(text):
        return text
    out, at = [], 0
    for s in sorted((int(a), int(b)) for a, b in (x.split(":")[1:] for _, _, x in spans(text))):
        if s[0] > at or not out:
            out += [text[at:s[0]], "[SECRET]"]
        at = max(at, s[1])
    return "".join(out) + text[at:]


def test_masks(spark, odd_documents, no_documents):
    own = texts()
    df = spark.createDataFrame(list(enumerate(own)), "starts int, text string")
    got = {r.starts: r.text for r in secrets.redact(df, "text").collect()}
    assert got == {i: masked(t) for i, t in enumerate(own)}
    clean = secrets.redact(odd_documents, "text")
    assert clean.columns == odd_documents.columns and clean.count() == odd_documents.count()
    assert clean.where("text like '%hunter2%'").isEmpty()
    assert secrets.redact(no_documents, "text").isEmpty() and secrets.scan_table(no_documents, "doc_id", "text").isEmpty()


def test_no_python_on_the_way(spark, odd_documents):
    plan = secrets.scan_table(odd_documents, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_many_findings_in_one_text(spark, monkeypatch):
    """Spans in, across and at the edges of blocks; characters of all widths; 80,000 findings in one text."""
    import random
    import time

    rnd = random.Random(2)
    part = lambda: rnd.choice(["é𝄞 ", "password=hunter2hunter2", " x ", "AKIA" + "Q" * 16, "\n\n", "deadbeef" * 5, "token: abcdefgh1 ", "AKIAQQ "])
    texts = ["".join(part() for _ in range(rnd.randrange(60))) for _ in range(150)] + ["AKIA" + "Q" * 16, "", "é" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (1, 7, 64, 4096):
        monkeypatch.setattr(secrets, "BLOCK", block)
        got = {r.doc_id: r.text for r in secrets.redact(df, "text").collect()}
        assert got == {i: masked(t) for i, t in enumerate(texts)}
    took = []
    for n in (20_000, 80_000):
        big = spark.createDataFrame([(1, "secret=abcdefgh12 " * n)], "doc_id long, text string")
        start = time.time()
        assert secrets.redact(big, "text").first().text == "[SECRET] " * n
        took.append(time.time() - start)
    assert took[1] < 4 * took[0] + 10
