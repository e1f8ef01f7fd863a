import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
from test_page_scan import HOSTILE, B, G, L

from touchline.functions import page_batch, page_scan
from touchline.operators import pages

PIECES = [
    f'<table id="{G}">', f"<table class='{B}'>", '<table class="table-striped"/>', "</table>", "<tr>", "</tr>", "<td>", "</td>",
    f'<td {L}="Home">', "<TD title='x'>", "<th>", "</th>", "<b>", "</b>", "<br>", "</br>", "<p>", "</p>", " a b ", "\n", "&amp;",
    " &nbsp;x", "\xa0y\xa0", "<!-- c -->", "<!-- <td> -->", "<!-->", "<script>", "</script>", "<script>a<b</script>",
    "<style>x</style>", "<", " > ", '"', "'", "<td/>", "<tr/>", f"<span {L}>", L, '<a href="x>y">', "<i a='\"' b=\">\">", "\x0b",
    "data&#45;th", f'<div id="{G}">', "</", "<é>", "<td data-TH=q>", "<TR class=a>", "</TR>",
]


def _nested(r, depth):
    if not depth:
        return "".join(r.choice([" t", "&lt;", "é ", "\xa0z", "<br>", "<!-- c -->", "<style>x</style>", L, f"<i {L}=1>u</i>"]) for _ in range(r.randint(0, 3)))
    tag = r.choice([["b", "span", "td"], ["td", f'td {L}="Away"', "th"], ["tr", "tr", "p"], [f'table id="{G}"', f"table class='x{B}'", "table"]][depth - 1])
    return f"<{tag}>" + "".join(_nested(r, depth - 1) for _ in range(r.randint(0, 4))) + f"</{tag.split()[0]}>"


def _same(texts):
    """Rows of the pages read at once equal those of the scan; the number of pages left to it."""
    left = 0
    for layout in page_batch.LAYOUTS:
        origin, numbers, marks, ends, labels, words, bad = page_batch.rows(pa.array(texts, pa.string()), layout)
        cells, found = list(zip(labels.to_pylist(), words.to_pylist())), {}
        for i, page in enumerate(origin.tolist()):
            found.setdefault(page, []).append((int(numbers[i]), bool(marks[i]), cells[ends[i] : ends[i + 1]]))
        assert not set(bad.tolist()) & set(found)
        for page, text in enumerate(texts):
            if page not in bad:
                assert found.get(page, []) == list(page_scan.LAYOUTS[layout](text or "")), (layout, text)
        left += len(bad)
    return left


def test_hostile_and_random_pages():
    r = random.Random(3)
    broken = ["".join(r.choice(PIECES) for _ in range(r.randint(1, 30))) for _ in range(2000)]
    nested = ["<html>" + _nested(r, 4) + _nested(r, 4) + "</html>" for _ in range(2000)]
    _same([None, "", *HOSTILE, *broken])
    assert _same(nested) < 0.6 * 2 * len(nested)


def test_raw_pages_and_batches_of_one_page():
    stored = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column("html").to_pylist()
    _same(stored)
    for page in HOSTILE:
        _same([page])


def test_parts_cover_all_pages_in_order():
    sizes = [0, 5_000_000, 10, 10] + [3_000_000] * 3 + [1] * 3000
    texts = pa.array([None if not n else "x" * n for n in sizes], pa.string())
    runs = list(page_batch.parts(texts))
    assert [start for start, _ in runs] == [sum(c for _, c in runs[:i]) for i in range(len(runs))]
    assert sum(c for _, c in runs) == len(sizes) and max(c for _, c in runs) <= page_batch.BATCH_PAGES
    assert list(page_batch.parts(texts.slice(0, 0))) == []


def test_well_nested_pages_take_less_than_the_scan():
    row = "<tr>" + "".join(f"<td>\n <b> cell {i} &amp; Co</b> </td>" for i in range(6)) + "</tr>"
    texts = [f'<html><body><br><table id="{G}">{row * 5}</table><p>{i}</p></body></html>' for i in range(1000)]
    batch = pa.array(texts)
    page_batch.rows(batch, "grid")
    begun = time.process_time()
    page_batch.rows(batch, "grid")
    fast, begun = time.process_time() - begun, time.process_time()
    for text in texts:
        list(page_scan.LAYOUTS["grid"](text))
    assert 3 * fast < time.process_time() - begun


def test_rows_of_a_mixed_table(spark):
    well, broken = f'<table id="{G}"><tr><td> a </td></tr></table>', f'<table id="{G}"><tr><td>b<tr><td>c'
    given = spark.createDataFrame([(1, well), (2, broken), (3, None), (4, "")], "page_id long, html string")
    rows = pages.table_rows(given, "grid").collect()
    found = sorted((r.page_id, r.row_no, [c.text for c in r.cells]) for r in rows)
    scan = [(i, n, [t for _, t in c]) for i, p in ((1, well), (2, broken)) for n, _, c in page_scan.LAYOUTS["grid"](p)]
    assert found == scan and {i for i, *_ in found} == {1, 2}
