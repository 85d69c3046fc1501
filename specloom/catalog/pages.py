"""Page extraction jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import is_block_page
from ..sources import pages as jobs
from .registry import query

C = F.col


def _spec_html(part):
    """A page per part, with the tables a real page has and some that must be ignored."""
    t = lambda e: F.col(e).cast("string")
    row = lambda k, v: F.concat(F.lit('<tr><td class="ttl"><a href=x>'), F.lit(k), F.lit('</a></td><td class="nfo">'), v, F.lit("</td></tr>"))
    return F.concat(
        F.lit("<html><body><table><tr><th>Other</th></tr></table><table><tr><th rowspan=2 scope=row>Body</th>"),
        row("Size", F.concat(t("p_size"), F.lit(" x 2 mm"))), row("Brand", t("p_brand")), F.lit("<tr><td>no classes</td></tr></table>"),
        F.lit("<table><tr><th>Body</th></tr>"), row("Size", F.lit("second table is ignored")), F.lit("</table>"),
        F.when(C("p_partkey") % 3 != 0, F.concat(F.lit("<table><tr><th> Misc </th></tr>"), row("Price", F.concat(
            F.lit("About &amp; "), t("p_size"), F.lit(" <b>EUR</b>"))), F.lit("</table>"))).otherwise(F.lit("")),
        F.lit("</body></html>"))


@query("page_spec_tables", """
    SELECT p_partkey, 'Body' AS section, 'Size' AS field, CAST(p_size AS VARCHAR) || ' x 2 mm' AS value FROM part
    UNION ALL SELECT p_partkey, 'Body', 'Brand', p_brand FROM part
    UNION ALL SELECT p_partkey, 'Misc', CASE WHEN p_partkey % 3 <> 0 THEN 'Price' END,
        CASE WHEN p_partkey % 3 <> 0 THEN 'About & ' || CAST(p_size AS VARCHAR) || ' EUR' END FROM part
    UNION ALL SELECT p_partkey, 'Sound', NULL, NULL FROM part""")
def _(i):
    part = i.spread("part")
    pages = part.select("p_partkey", _spec_html(part).alias("html"))
    return jobs.extract_spec_tables(pages, ["Body", "Misc", "Sound"], "p_partkey")


@query("page_prices", """
    SELECT p_partkey, '128GB 6GB RAM' AS config, '$ ' || CAST(p_size + 1 AS VARCHAR) AS price FROM part WHERE p_partkey % 4 <> 0
    UNION ALL SELECT p_partkey, '256GB', '€ 7' FROM part WHERE p_partkey % 4 <> 0""")
def _(i):
    cell = lambda c, p: F.concat(F.lit("<tr><td>"), c, F.lit('</td><td><a href="#">'), p, F.lit("</a></td></tr>"))
    size = C("p_size").cast("string")
    table = F.concat(
        F.lit('<table class="pricing inline widget x"><tr><th>Config</th></tr>'), cell(F.lit("128GB 6GB RAM"), size),
        cell(F.lit(" 256GB "), F.lit("€ 7")), cell(F.lit("   "), F.lit("€ 100")), F.lit("<tr><td>512GB</td><td>no link</td></tr>"),
        cell(F.lit("128GB 6GB RAM"), F.concat(F.lit("$ "), (C("p_size") + 1).cast("string"))), F.lit("</table>"))
    html = F.when(C("p_partkey") % 4 == 0, F.concat(F.lit("<table class=pricing>"), size)).otherwise(table)
    return jobs.extract_price_table(i.spread("part").select("p_partkey", html.alias("html")), "p_partkey")


@query("page_links", """
    SELECT page_id, unnest(regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)) AS name,
           'http://pages.example.com' || unnest(regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) AS url
    FROM (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages) q""")
def _(i):
    return jobs.extract_links(i.table("pages"), "nav ul li a", "http://pages.example.com/")


@query("page_brand_links", """
    SELECT p_partkey, p_name AS name, 'https://x.example.com/' || CAST(p_size AS VARCHAR) || '.php' AS url FROM part
    UNION ALL SELECT p_partkey, p_type, 'https://x.example.com/t.php' FROM part""")
def _(i):
    html = F.concat(F.lit("<table><tr><td><a href="), C("p_size").cast("string"), F.lit(".php>"), "p_name", F.lit("<br><span>"),
                    C("p_size").cast("string"), F.lit(" devices</span></a></td><td><a href='t.php'>"), "p_type", F.lit("<br>12 devices</a></td></tr></table>"))
    return jobs.extract_brand_links(i.spread("part").select("p_partkey", html.alias("html")), "https://x.example.com/", "p_partkey")


@query("page_next_link", """
    SELECT p_partkey, 'https://x.example.com/p' || CAST(p_partkey + 1 AS VARCHAR) AS url FROM part WHERE p_partkey % 2 = 0""")
def _(i):
    html = F.concat(F.lit('<a class="prevnextbutton" title="Previous page" href="p0">b</a>'), F.when(C("p_partkey") % 2 == 0, F.concat(
        F.lit('<a href="p'), (C("p_partkey") + 1).cast("string"), F.lit('" class="x prevnextbutton" title="Next page">n</a>'))).otherwise(F.lit("")))
    return jobs.next_page(i.spread("part").select("p_partkey", html.alias("html")), "https://x.example.com/", "p_partkey")


@query("page_block_flag", """
    SELECT page_id, CASE WHEN page_id % 9 = 0 THEN true ELSE contains(html, 'Access denied') OR contains(html, 'hcaptcha')
        OR contains(html, 'cf-challenge') OR contains(html, 'Just a moment') OR contains(html, 'Attention Required') END AS blocked
    FROM pages""")
def _(i):
    html = F.when(C("page_id") % 9 == 0, F.concat("html", F.lit("<p>Just a moment...</p>"))).otherwise(C("html"))
    return i.table("pages").select("page_id", is_block_page(html).alias("blocked"))
