"""Property tests: flag rules against a plain model, sequence ids, failed rows within reports."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewatch.functions import freshness_flag, match_flag
from tablewatch.operators import failed_checks
from tablewatch.operators.sequence import consecutive_ids

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.one_of(st.none(), st.integers(min_value=0, max_value=3))


def model_match(a, *others):
    if a is None:
        return ""
    return "Y" if all(o is not None and o == a for o in others) else "N"


@SETTINGS
@given(st.lists(st.tuples(small, small, small), min_size=1, max_size=20))
def test_match_flag_model(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = [tuple(r) for r in df.select(match_flag("a", "b", "c"), match_flag("a", "b")).collect()]
    assert got == [(model_match(a, b, c), model_match(a, b)) for a, b, c in rows]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-3000, max_value=3000)), min_size=1, max_size=20))
def test_freshness_model(spark, minutes):
    as_of = dt.datetime(2024, 1, 31, 12, 0)
    stamps = [None if m is None else as_of - dt.timedelta(hours=24) + dt.timedelta(minutes=m) for m in minutes]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    got = [r[0] for r in df.select(freshness_flag("t", as_of)).collect()]
    want = ["" if t is None else ("Y" if t > as_of - dt.timedelta(hours=24) else "N") for t in stamps]
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=0, max_size=40), st.integers(0, 100))
def test_consecutive_ids_model(spark, keys, start):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    rows = consecutive_ids(df, [F.col("k").asc_nulls_first()], start, "seq").collect()
    seqs = sorted(r.seq for r in rows)
    assert seqs == list(range(start + 1, start + 1 + len(keys)))
    order = sorted(rows, key=lambda r: r.seq)
    rank = {None: 0, "a": 1, "b": 2, "c": 3}
    assert [rank[r.k] for r in order] == sorted(rank[k] for k in keys)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["Y", "N", ""]), st.sampled_from(["Y", "N", ""])), min_size=0, max_size=20))
def test_failed_rows_subset(spark, flags):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(flags)], "i int, a string, b string")
    got = {r.i for r in failed_checks(df, ["a", "b"], ["b"]).collect()}
    assert got == {i for i, (a, b) in enumerate(flags) if a == "N" or b == "N" or b == ""}


# --- reconcile_counts against a plain-Python model of its SQL -----------------------------------

NAMES = ["ORDERS", "orders", "Cust", "CUST", "X"]
count_or_null = st.one_of(st.none(), st.integers(min_value=0, max_value=2))
profile_rows = st.lists(
    st.tuples(st.sampled_from(NAMES), count_or_null, count_or_null, st.booleans()), min_size=0, max_size=4
)


def _flag(anchor, *others):
    if anchor is None:
        return ""
    return "Y" if all(o is not None and o == anchor for o in others) else "N"


def _model(tgt, rep, legacy, extra, as_of):
    rows, cols = set(), set()
    for tn, tr, tc, tla in tgt:
        for rn, rr, rc, rla in rep:
            if tn.lower() == rn.lower():
                rows.add((tn, "T", "DB", tr, rr, tla))
                cols.add((tn, tc, rc))
    for rn, rr, rc, rla in rep:
        if rn in extra:
            rows.add((rn, "R", "DB", None, rr, rla))
            cols.add((rn, None, rc))
    out = set()
    cut = as_of - dt.timedelta(hours=24)
    for n, sch, db, tr, rr, la in rows:
        cs = [c for c in cols if c[0] == n] or [(n, None, None)]
        ls = [l for l in legacy if l[0] == n] or [(n, None, None)]
        for _, tc, rc in cs:
            for _, lr, lc in ls:
                fresh = "" if la is None else ("Y" if la > cut else "N")
                out.add((n, sch, db, tr, rr, lr, tc, rc, lc, la, fresh, _flag(rr, tr, lr), _flag(rc, tc, lc)))
    return out


@SETTINGS
@given(profile_rows, profile_rows, st.lists(st.tuples(st.sampled_from(NAMES), count_or_null, count_or_null), max_size=3),
       st.lists(st.sampled_from(NAMES), max_size=2))
def test_reconcile_counts_model(spark, tgt, rep, legacy, extra):
    from tablewatch.operators import reconcile_counts
    from tablewatch.schemas import TABLE_PROFILE

    as_of = dt.datetime(2024, 1, 31)
    changed = lambda fresh: as_of - dt.timedelta(hours=1) if fresh else None
    tgt = [(n, r, c, changed(f)) for n, r, c, f in tgt]
    rep = [(n, r, c, changed(f)) for n, r, c, f in rep]
    tdf = spark.createDataFrame([("DB", "T", n, "BASE TABLE", r, c, la) for n, r, c, la in tgt], TABLE_PROFILE)
    rdf = spark.createDataFrame([("DB", "R", n, "BASE TABLE", r, c, la) for n, r, c, la in rep], TABLE_PROFILE)
    ldf = spark.createDataFrame(legacy, "tablename string, rowcount long, columncount long")
    got = reconcile_counts(tdf, rdf, ldf, as_of=as_of, extra=extra).collect()
    got_set = {
        (r.table_view_name, r.schema_name, r.database_name, r.target_rows, r.replica_rows, r.legacy_rows,
         r.target_columns, r.replica_columns, r.legacy_columns, r.last_altered, r.daily_refresh_check,
         r.rows_match_check, r.columns_match_check)
        for r in got
    }
    assert len(got) == len(got_set)  # the report is distinct
    assert got_set == _model(tgt, rep, legacy, extra, as_of)


# --- column_drift / missing_columns against plain-Python models ---------------------------------

col_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.sampled_from(["K", "X_WID", "X_WID  ", "x_wid", "V"]),
        st.sampled_from(["YES", "NO"]),
        st.sampled_from(["TEXT", "NUMBER"]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=2)),
    ),
    max_size=6,
    unique_by=lambda r: (r[0], r[1]),
)


@SETTINGS
@given(col_rows, col_rows)
def test_drift_and_missing_models(spark, rep, tgt):
    from tablewatch.operators import column_drift, missing_columns
    from tablewatch.schemas import COLUMN_PROFILE

    as_of = dt.datetime(2024, 1, 31)
    to_df = lambda rows, sch: spark.createDataFrame(
        [("DB", sch, t, c, i, n, ty, ln) for i, (t, c, n, ty, ln) in enumerate(rows, 1)], COLUMN_PROFILE
    )
    rdf, tdf = to_df(rep, "R"), to_df(tgt, "T")
    typed = lambda ty, ln: ty + str(1 if ln is None else ln)
    want = set()
    for rt, rc, rn, rty, rln in rep:
        for tt, tc, tn, tty, tln in tgt:
            if (rt, rc) == (tt, tc) and (rn != tn or rty != tty):
                ok = typed(rty, rln) == typed(tty, tln) or rc.rstrip().endswith("WID")
                want.add((tt, tc, "Y" if ok else "N", "Y" if rn == tn else "N"))
    got = {(r.target_table_name, r.target_column_name, r.data_type_length_check, r.is_nullable_check)
           for r in column_drift(rdf, tdf, as_of=as_of).collect()}
    assert got == want
    rep_keys, rep_tables = {(t, c) for t, c, *_ in rep}, {t for t, *_ in rep}
    want_missing = {(t, c) for t, c, *_ in tgt if (t, c) not in rep_keys and t in rep_tables}
    got_missing = {(r.target_table_name, r.target_column_name) for r in missing_columns(tdf, rdf, as_of=as_of).collect()}
    assert got_missing == want_missing


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-3 * 24 * 60, max_value=24 * 60)), max_size=30),
       st.booleans())
def test_daily_counts_model(spark, minutes, include_empty):
    from tablewatch.operators import daily_ingest_counts

    as_of = dt.datetime(2024, 1, 31)
    stamps = [None if m is None else as_of + dt.timedelta(minutes=m) for m in minutes]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    rows = daily_ingest_counts(df, "T", "ts", as_of, include_empty=include_empty).collect()
    day = dt.date(2024, 1, 30)
    n = sum(1 for t in stamps if t is not None and t.date() == day)
    want = [(day, n)] if (n or include_empty) else []
    assert [(r.ingest_date, r.ingested_rows) for r in rows] == want
