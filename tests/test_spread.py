"""Work on rows of a small file: dealt over all cores, and plain pages read without the general parser."""

import pytest
from pyspark.sql import functions as F

from specloom.catalog import QUERIES
from specloom.catalog.inputs import Inputs
from specloom.sources import pages as jobs


@pytest.fixture
def folder(spark, tmp_path):
    """One file of one row group."""
    rows = spark.range(400).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("name "), F.col("id")).alias("p_name"), F.concat(F.lit("Brand#"), F.col("id") % 5).alias("p_brand"),
        F.lit("LARGE").alias("p_type"), (F.col("id") % 9).cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice"))
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_raw_pages_and_prices_of_one_file_are_read_by_many_tasks(spark, folder):
    assert tasks(Inputs(spark, folder, dealt=True).raw_pages) > 1
    assert sorted(r.part_id for r in Inputs(spark, folder, dealt=True).raw.select("part_id").collect()) == list(range(400))


@pytest.mark.parametrize("name", ["page_spec_tables", "page_prices", "page_brand_links", "page_next_link"])
def test_pages_of_one_file_are_parsed_by_many_tasks(spark, folder, name):
    assert tasks(QUERIES[name](spark, folder)) > 1


def shape(node):
    return node if isinstance(node, str) else (node.tag, node.attrs, set(node.classes), [shape(k) for k in node.kids])


def by_parser(html):
    tree = jobs._Tree()
    tree.feed(html)
    tree.close()
    return shape(tree.root)


@pytest.mark.parametrize("html", [
    "", "text", "<p>a &amp; b &lt</p>", "<A HREF=x Class='b  c'>n</A>", "<table><tr><td class=\"ttl\">x<td>y</table>z", "<a b c=\"\">q<br>r</b></a>",
    "<p>one<p>two</i></p> &am", "<a x=1 x=\"2\">", "</p>late"])
def test_plain_pages_give_the_tree_of_the_general_parser(html):
    assert shape(jobs._plain_tree(html)) == by_parser(html)


@pytest.mark.parametrize("html", [
    "<!doctype html><p>x", "<script>a<b</script>", "<a b=\"1\"c>", "<br/>", "a < b", "<!-- c -->", "</p >", "<a href=a/b>", "<a x=\"&amp;\">", "<td"])
def test_other_pages_go_to_the_general_parser(html):
    assert jobs._plain_tree(html) is None
    assert shape(jobs._tree(html)) == by_parser(html)
