import duckdb
import pytest
from checks.compare import compare, connect
from marketloom.llm import queries, site_lines
from pyspark.sql import functions as F

from .helpers import SF


def pages(spark):
    rows = [(i, f"http://user@Site.example:80/{i}", f"<p>Menu</p><div>Text {i % 6}</div><p>Menu</p><li>own &amp; {i}") for i in range(10)]
    rows += [(20 + i, f"https://small.example/{i}", "<p>Same line</p>") for i in range(4)]
    rows += [(30, None, "<p>Menu</p>"), (31, "not an address", "<p>Menu</p>"), (32, "http://site.example/x", None), (33, "http://site.example/y", ""), (32, "http://site.example/x", None)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_lines_on_many_pages_of_a_host_go(spark):
    rows = {r.page_id: r for r in site_lines.clean(pages(spark)).collect()}
    assert rows[3].text == "Text 3\nown & 3" and rows[3].n_lines == 4 and rows[3].n_dropped == 2 and rows[3].host == "site.example"
    assert rows[20].text == "" and rows[30].text == "Menu" and rows[31].text == "Menu"
    assert rows[30].host is None and rows[32].text == "" and rows[32].n_lines == 0
    assert site_lines.clean(pages(spark)).count() == 19


@pytest.mark.parametrize("n", range(1, 6))
def test_small_hosts_are_cleaned_by_the_same_rule(spark, n):
    """A line on all pages goes from two pages on; one on a single page stays, though it is over the ratio on hosts of up to three."""
    rows = [(i, f"http://small{n}.example/{i}", f"<p>Menu</p><p>own {i}</p>") for i in range(n)]
    got = sorted(r.text for r in site_lines.clean(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect())
    assert got == (["Menu\nown 0"] if n == 1 else [f"own {i}" for i in range(n)])


def test_ratio_and_empty_table(spark):
    rows = {r.page_id: r for r in site_lines.clean(pages(spark), ratio=0.1).collect()}
    assert rows[0].text == "own & 0"  # Text 0 stands on 2 of 13 pages
    assert site_lines.clean(pages(spark).limit(0)).count() == 0
    clash = pages(spark).withColumns({"host": F.lit(1), "lines": F.lit(2), "drop": F.lit(3)})
    assert site_lines.clean(clash).count() == 19


def test_query_matches_its_sql(spark):
    outcome, text = compare(spark, connect(SF), SF, "op9_site_lines", queries.QUERIES["op9_site_lines"], queries.ORACLE["op9_site_lines"])
    assert outcome == "ok", text


@pytest.mark.parametrize("html", ["<script>var a='<p>x</p>';</script><p>y", "a<!-- <p>b</p> -->c", "<STYLE>p{}</STYLE>\n\n<b>bold</b> text"])
def test_unseen_parts(spark, html):
    text = spark.createDataFrame([(html,)], "html string").select(F.array_join(site_lines.lines_of("html"), "|")).first()[0]
    want = {"<s": "y", "a<": "a c", "<S": "bold text"}[html[:2]]
    assert text == want and duckdb.__version__
