"""ANSI SQL that states each query's result directly from the rules, for an independent check.

The statements avoid the engine's own plans on purpose: ranges are joined as ranges, factors
are products over correlated rows, the portfolio chain is written out.
"""
