"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

from pathlib import Path

import duckdb
import pytest

from cordillera.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    kinds = dict(zip(names, (str(x[1]) for x in found.description)))
    assert sorted(df.columns) == sorted(names)
    assert {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema} == kinds
    order = sorted(names)
    want = sorted(tuple(plain(row[names.index(c)]) for c in order) for row in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_points(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["type", "records", "members"]


def test_every_order_is_linked_or_an_entity(spark, duck):
    ids = {r[0].split("|")[0] for r in QUERIES["enrich_and_standalone"](spark, SF).select("id").collect()}
    ids |= {r[0].split("|")[0] for r in QUERIES["link_products"](spark, SF).select("product_id").collect()}
    assert ids == {str(k) for (k,) in duck.execute("SELECT DISTINCT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey").fetchall()}


def test_no_line_or_order_is_left_out(spark, duck):
    assert QUERIES["authorship_status"](spark, SF).count() == duck.execute("SELECT count(DISTINCT l_partkey) FROM lineitem").fetchone()[0]
    assert sum(r.n for r in QUERIES["snapshot_diff"](spark, SF).collect()) == duck.execute("SELECT count(*) FROM orders").fetchone()[0]


def test_command_line(spark, tmp_path):
    from cordillera.__main__ import main

    said = main(["--list", "--sql", "page_status", "--run", "type_distribution", "--data", SF, "--out", f"file://{tmp_path}"], spark)
    assert "type_distribution *" in said and said[-1] == "type_distribution: written" and any("noindex" in x for x in said)
    assert spark.read.parquet(f"file://{tmp_path}/type_distribution").columns == ["type", "records", "members"]
    with pytest.raises(SystemExit):
        main(["--run", "nothing", "--data", SF, "--out", "x"], spark)


def test_titles_and_links_as_written_match_sql(spark, tmp_path):
    odd = ["<title>a&&amp</title>", "<title>x = &quot;0 &amp;lt; &amp;amp;</title>", "<title>a\x0bb \n c</title><svg><title>d</title></svg>", None, "", "<html lang='es'><a href='x'>", "<!-- <a href=\"x\"> --><A HREF=\"y\"><a id=1 href=\"z\"><a href=\"\">", "<title>é\xa0</title><title>b</title>"]
    spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["html_title_links"](spark, str(tmp_path)).select("id", "title", "lang", "links").collect()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = connection.execute(f"SELECT id, title, lang, links FROM ({ORACLE_SQL['html_title_links']})").fetchall()
    assert sorted(map(tuple, found)) == sorted(want)


def test_merged_entities_of_lines_without_flag_or_part_match_sql(spark, tmp_path):
    orders = [(1, 7), (2, 8), (3, None)]
    lines = [(1, 5, 9, 1, None, "F"), (1, 5, 4, 2, "N", "O"), (2, 5, 3, 1, "A", "F"), (2, 6, 2, 2, None, None), (3, None, 1, 1, "A", "F"), (3, None, 1, 2, "N", "O"), (3, 8, None, 3, "", "F"), (1, 9, 4, 3, None, "F"), (2, 9, 4, 3, "N", "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    connection = duckdb.connect()
    for name in ("orders", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = connection.execute(ORACLE_SQL["merged_entities"])
    names = [x[0] for x in found.description]
    assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r)) for r in QUERIES["merged_entities"](spark, str(tmp_path)).select(*names).collect())


def test_group_products_are_not_grouped_as_pages_once_parsed(spark):
    plan = QUERIES["group_products"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "MapInPandas" not in plan and "Generate" not in plan


def test_group_sections_make_and_parse_each_page_once(spark):
    plan = QUERIES["group_sections"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("lineitem.parquet") == 1 and "Union" not in plan
