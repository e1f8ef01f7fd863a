import pyarrow.parquet as pq
import pytest

from touchline.functions import fixed_values as fixed
from touchline.functions import markup, page_scan
from touchline.plans import page_queries

L, B, G, H = fixed.CELL_LABEL_ATTRIBUTE, fixed.BASE_TABLE_CLASS, fixed.GRID_TABLE_ID, fixed.EVENTS_HEADER
HOSTILE = [
    "",
    "<table>",
    f"<table class='{B}'><tr><td>a<td>b<td>c<td>d</table>",
    f"<div><p>{H}</p><span>{H}</span><table class='{B} x'><tr><td>1</td><td>2</td><td>3</td><td>4<table><tr><td>in</td></tr></table></td></tr></table></div>",
    f"<div>{H}<b>{H}</b>tail {H}</div><table class='{B}'><tr><td>1<td>2<td>3<td>4</tr></table>",
    f"<section><table class='{B}'/><div><div><div><div><div><p>{H}</p></div></div></div></div></div><table class='{B}'><tr><td>x<td>y<td>z<td>w</table></section>",
    f"<table id='{G}'><tr><th>h</th></tr><tr><td> a </td><td>&amp; b<br {L}='q'></td></tr><tr/><tr><td/></tr></table>",
    f"<div id='{G}'><table><tr><td>1</td></tr></table><tr><td>2</td></tr></div><table id='{G}'><tr><td>no</td></tr></table>",
    f"<table class='{B}'><tr><td {L}=' Home '>x</td></tr><tr><td><span {L}>y</span></td><td>{L} in text</td></tr><tr><td>z</td></tr></table>",
    f"<TABLE CLASS='{B}'><TR><TD>A<TD>B</TR></TABLE></b></tr><td>stray<script><td>no</td></script><style>x</style>",
    "<table id='x' class='a b'><tr><td>1</td></tr><!-- <tr><td>c</td></tr> --><tr><td>2</td></tr><tr><td>3</table><td",
    f"<table class='{B}'><tr><td title=\"a>b\" {L}='v'>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr>",
]


def same(pages):
    for html in pages:
        for name, old in markup.LAYOUTS.items():
            assert list(page_scan.LAYOUTS[name](html)) == list(old(html)), (name, html[:200])


def test_hostile_pages():
    same(HOSTILE + [h * 3 for h in HOSTILE])


def test_raw_pages_of_the_test_data():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column("html").to_pylist()
    same(p or "" for p in pages)


@pytest.mark.parametrize("build", [page_queries._schedule_pages, page_queries._event_pages, lambda s, d: page_queries._grid_pages(s, d, True), lambda s, d: page_queries._grid_pages(s, d, False)])
def test_generated_pages(spark, build):
    same(r.html for r in build(spark, "/root/testdata/sf0.001").select("html").collect())
