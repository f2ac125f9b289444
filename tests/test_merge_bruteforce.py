"""Merges against a plain-Python model of the SQL semantics on random small inputs."""

from datetime import date, datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from martworks.operators import merge

SCHEMA = "k string, v int, note string, loaded_at timestamp_ntz"
BATCH = "k string, v int, note string, loaded_at timestamp_ntz, seq int"
KEYS = st.sampled_from(["a", "b", "c", "d", None])
DAY0 = datetime(2024, 1, 1)


def _target_rows(draw_rows):
    seen, out = set(), []
    for k, v, note, day in draw_rows:
        if k is not None and k in seen:
            continue  # a keyed table: one row per non-NULL key
        if k is not None:
            seen.add(k)
        out.append((k, v, note, None if day is None else DAY0 + timedelta(days=day)))
    return out


rows_st = st.lists(st.tuples(KEYS, st.integers(0, 9), st.sampled_from(["x", "y", None]),
                             st.one_of(st.none(), st.integers(0, 3))), max_size=8)
batch_st = st.lists(st.tuples(KEYS, st.integers(10, 19), st.sampled_from(["p", "q"])), max_size=8)


def _norm(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def model_upsert(target, batch, stamp):
    """INSERT ... ON CONFLICT (k) DO UPDATE SET v, loaded_at; rows applied in seq order."""
    table = [list(r) for r in target]
    for k, v, note, _, _seq in sorted(batch, key=lambda r: r[4]):
        hit = next((r for r in table if k is not None and r[0] == k), None)
        if hit:
            hit[1], hit[3] = v, stamp
        else:
            table.append([k, v, note, stamp])
    return _norm(table)


def model_insert_ignore(target, batch):
    table = [list(r) for r in target]
    for k, v, note, loaded, _seq in sorted(batch, key=lambda r: r[4]):
        if k is None or not any(r[0] == k for r in table):
            table.append([k, v, note, loaded])
    return _norm(table)


def model_reload_day(target, batch, day):
    if not batch:
        return _norm(target)
    kept = [r for r in target if r[3] is None or r[3].date() < day]
    return model_insert_ignore(kept, batch)


@settings(max_examples=10, deadline=None)
@given(rows_st, batch_st)
def test_merges_match_model(spark, trows, brows):
    target_rows = _target_rows(trows)
    stamp = datetime(2024, 1, 3, 12)
    batch_rows = [(k, v, note, stamp, i) for i, (k, v, note) in enumerate(brows)]
    target = spark.createDataFrame(target_rows, SCHEMA)
    batch = spark.createDataFrame(batch_rows, BATCH)
    cols = ["k", "v", "note", "loaded_at"]
    up = merge.upsert(target, batch, ["k"], ["seq"], update_cols=["v"], stamp=("loaded_at", stamp))
    assert _norm(up.select(*cols).collect()) == model_upsert(target_rows, batch_rows, stamp)
    ins = merge.insert_ignore(target, batch, ["k"], order_by=["seq"])
    assert _norm(ins.select(*cols).collect()) == model_insert_ignore(target_rows, batch_rows)
    day = date(2024, 1, 3)
    rel = merge.reload_day(target, batch, ["k"], day, order_by=["seq"])
    assert _norm(rel.select(*cols).collect()) == model_reload_day(target_rows, batch_rows, day)
