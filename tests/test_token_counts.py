"""Tokens are counted as they stand: a row for each different one, not for each occurrence."""

from lamina.operators import boundaries as B


def test_different_tokens(spark):
    df = spark.createDataFrame([(" One two (three.) Two one! One two\n",), ("two two two",), (None,), ("",)] * 50, "text string")
    toks = B.tokens(df).collect()
    assert len(toks) < 15 and sum(r.n for r in toks) == 10 * 50
    got = {r.type: (r.with_dot, r.without, r.lower, r.upper_inside) for r in B.counts(B.tokens(df)).collect()}
    assert got == {"one": (0, 100, 0, 0), "one!": (0, 50, 50, 0), "two": (0, 300, 250, 0), "three": (50, 0, 50, 0)}
    two = {(r.prev, r.type): (r.n, r.n_upper) for r in B.pairs(B.tokens(df)).collect()}
    assert two == {("three", "two"): (50, 50), (None, "one"): (50, 50)}
