"""Randomised checks of the MERGE operator against a brute-force model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripmart.operators.merge import upsert

KEYS = st.sampled_from(["a", "b", "c", "d", None])
ROW = st.tuples(KEYS, st.integers(0, 2), st.integers(0, 99))


def brute_force(target, source, null_safe, delete_missing=False):
    """MERGE semantics row by row: matched → source value (created kept), else insert;
    with ``delete_missing`` target rows without a source match are dropped."""
    def same(x, y):
        return x == y if null_safe else (x is not None and y is not None and x == y)

    out = []
    for t in target:
        hit = [s for s in source if same(t[0], s[0])]
        if hit:
            out.append((t[0], hit[0][1], hit[0][2], t[3]))
        elif not delete_missing:
            out.append(t)
    for s in source:
        if not any(same(t[0], s[0]) for t in target):
            out.append(s)
    return sorted(out, key=repr)


@settings(max_examples=16, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.lists(ROW, max_size=5, unique_by=lambda r: r[0]),
    source=st.lists(ROW, max_size=5, unique_by=lambda r: r[0]),
    null_safe=st.booleans(),
    delete_missing=st.booleans(),
)
def test_upsert_matches_brute_force(spark, target, source, null_safe, delete_missing):
    schema = "k string, part int, v int, created string"
    t_rows = [(k, p, v, "t") for k, p, v in target]
    s_rows = [(k, p, v, "s") for k, p, v in source]
    if not null_safe:
        # '=' keys: NULL keys never match, and MERGE rejects NULL duplicates the same way
        s_rows = [r for r in s_rows if r[0] is not None]
    t_df = spark.createDataFrame(t_rows, schema)
    s_df = spark.createDataFrame(s_rows, schema)
    merged = upsert(
        t_df, s_df, ["k"], preserve=["created"], null_safe=null_safe, delete_missing=delete_missing
    ).merged
    got = sorted((tuple(r) for r in merged.collect()), key=repr)
    assert got == brute_force(t_rows, s_rows, null_safe, delete_missing)
