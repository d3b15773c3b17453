"""Dimension renewal against a few lines of Python, on random dimensions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tarn.operators.mutate import merge_insert, merge_update, renew_dimension
from tests.conftest import rows

members = st.dictionaries(st.integers(-20, 20), st.text("abc", max_size=3), max_size=15)


def model(dim, incoming):
    known = {key for _, key, _ in dim}
    updated = [(sk, key, incoming.get(key, label)) for sk, key, label in dim]
    first = max((sk for sk, _, _ in dim), default=0) + 1
    fresh = sorted(set(incoming) - known)
    return sorted(updated + [(first + i, key, incoming[key]) for i, key in enumerate(fresh)])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(members, members, st.integers(1, 5))
def test_renewal_follows_the_model(spark, known, incoming, step):
    dim = [(i * step, key, label) for i, (key, label) in enumerate(known.items(), 1)]
    schema = "SurrKey int, ID int, Label string"
    target = spark.createDataFrame(dim, schema)
    source = spark.createDataFrame([(-1, key, label) for key, label in incoming.items()], schema)

    renewed = renew_dimension(target, source)
    assert rows(renewed) == model(dim, incoming)
    assert rows(renew_dimension(renewed, source)) == model(dim, incoming)

    updated = merge_update(target, source)
    assert [r[:2] for r in rows(updated)] == sorted(r[:2] for r in dim)
    inserted = merge_insert(target, source)
    assert inserted.count() == len(dim) + len(set(incoming) - set(known))
