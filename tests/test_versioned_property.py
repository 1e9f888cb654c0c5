"""Versioned tables vs a brute-force model: random commit sequences, every version."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.plans.versioned import VersionedTable

SCHEMA = "k string, part int, v int"
ROWS = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(1, 3), st.integers(0, 9)), max_size=4)
OPS = st.lists(
    st.one_of(
        st.tuples(st.just("append"), ROWS),
        st.tuples(st.just("overwrite"), ROWS),
        st.tuples(st.just("replace"), ROWS, st.sets(st.integers(1, 3), min_size=1)),
        st.tuples(st.just("delete"), st.sampled_from("abcd")),
    ),
    min_size=1,
    max_size=5,
)


def apply(model, op):
    kind = op[0]
    if kind == "append":
        return model + list(op[1])
    if kind == "overwrite":
        return list(op[1])
    if kind == "replace":
        parts = op[2]
        return [r for r in model if r[1] not in parts] + [r for r in op[1] if r[1] in parts]
    return [r for r in model if r[0] != op[1]]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ops=OPS)
def test_every_version_matches_the_model(spark, tmp_path_factory, ops):
    root = str(tmp_path_factory.mktemp("vt"))
    table = VersionedTable(spark, root, StructType.fromDDL(SCHEMA), partition_by=["part"])
    model, versions = [], {}
    for op in ops:
        kind = op[0]
        if kind == "append":
            cid = table.append(spark.createDataFrame(op[1], SCHEMA))
        elif kind == "overwrite":
            cid = table.overwrite(spark.createDataFrame(op[1], SCHEMA))
        elif kind == "replace":
            rows = [r for r in op[1] if r[1] in op[2]]
            cid = table.replace_partitions(spark.createDataFrame(rows, SCHEMA), [{"part": p} for p in sorted(op[2])])
        else:
            cid = table.delete_where(F.col("k") == op[1])
        model = apply(model, op)
        if cid is not None:
            versions[cid] = sorted(model)
    for cid, expected in versions.items():
        assert sorted(tuple(r) for r in table.as_of(cid).collect()) == expected, (ops, cid)
    assert sorted(tuple(r) for r in table.as_of().collect()) == sorted(model)
    assert table.row_count() == len(model)
