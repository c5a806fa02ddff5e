import __spark_entry__ as entry
from tests.conftest import DATA


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) > 40


def test_sample_of_queries_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "events", "documents", "labels", "conversations", "pages", "part", "supplier"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    q, s = entry.queries(), entry.oracle_sql()
    made = [n for n, f in q.items() if f.__module__.endswith((".editions", ".publish")) and n in s]
    assert len(made) > 40
    for name in (*made, "v2_v8_v10_cross_field", "v1_v9_schema_errors", "x1_x2_j10_annotate", "range_label", "merge_patch", "dedup_argmax_text", "asof_last_view", "sequence_gaps", "previous_plus_one", "html_profile", "render_markdown", "source_statistics"):
        df, rel = q[name](spark, DATA), con.sql(s[name])
        names = sorted(df.columns)
        columns = list(rel.columns)
        assert sorted(columns) == names
        want = sorted(repr(tuple(r[columns.index(c)] for c in names)) for r in rel.fetchall())
        assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == want, name
