"""Property tests: the text-to-int cast against an independent Python model."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanscore.functions.casts import int_trunc_sql

PLAIN = re.compile(r"^[ \t]*([+-]?[0-9]*)([.][0-9]*)?[ \t]*$")


def model(s):
    """Plain decimal text (optional sign, digits, optional fraction, blanks) -> int, truncated.

    What stands before the point may be missing ('.5', '-.', '.'), and is 0 then.
    """
    found = None if s is None else PLAIN.match(s)
    if not found or found[1] in ("", "+", "-") and found[2] is None:
        return None
    v = 0 if found[1] in ("", "+", "-") else int(found[1])
    return v if -(2**31) <= v < 2**31 else None


texts = st.one_of(
    st.none(),
    st.text(alphabet="0123456789+-. \te", max_size=8),
    st.from_regex(r"\A[ ]?[+-]?[0-9]{1,11}(\.[0-9]{0,3})?[ ]?\Z"),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(texts, min_size=100, max_size=100))
def test_int_text_cast_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(F.expr(int_trunc_sql("x"))).collect()]
    assert got == [model(v) for v in values]


rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", "d"]),
        st.one_of(st.none(), st.dates(min_value=__import__("datetime").date(2007, 1, 1),
                                      max_value=__import__("datetime").date(2019, 12, 1))),
        st.one_of(st.none(), st.integers(min_value=-(2**31), max_value=2**31 - 1)),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=8, deadline=None)
@given(rows_strategy)
def test_latest_row_matches_brute_force(spark, rows):
    from loanscore.operators.common import latest_per_member

    # make (member, issue_d, id) unambiguous: drop rows repeating a member's (issue_d, id)
    seen, data = set(), []
    for i, (m, d, ident) in enumerate(rows):
        if (m, d, ident) in seen:
            continue
        seen.add((m, d, ident))
        data.append((m, d, ident, float(i), f"s{i}"))
    df = spark.createDataFrame(data, "m string, issue_d date, id int, v double, s string")
    got = {r.m: (r.v, r.s) for r in latest_per_member(df, "m", ["v", "s"]).collect()}

    def rank(row):
        _, d, ident, _, _ = row
        return (d is not None, d.toordinal() if d else 0, ident is not None, ident if ident is not None else 0)

    want = {}
    for row in data:
        if row[0] not in want or rank(row) > rank(want[row[0]]):
            want[row[0]] = row
    assert got == {m: (r[3], r[4]) for m, r in want.items()}
