import pytest
from pyspark.sql import functions as F

from touchline.functions import markup
from touchline.operators import pages

MODERN = """<table id="ctl00_c_Schedule1_GridView1"><tr><th>League</th></tr>
<tr><td data-th="League">Prem</td><td data-th="Home"><a>A &amp; Co</a></td><td data-th="">3 - 2</td>
<td data-th="Away">B</td><td data-th="Time/Status">Complete</td><td data-th="Venue">1</td><td data-th="Officials">R</td></tr>
<tr><td data-th="League">Prem</td><td data-th="Home">C</td></tr></table>"""


def games(spark, html, layout="schedule"):
    rows = pages.table_rows(spark.createDataFrame([(1, html)], "id int, html string"), layout)
    read = {"schedule": pages.schedule_games, "events": pages.event_games, "grid": pages.grid_games}[layout]
    return [r.asDict() for r in read(rows).orderBy("row_no").collect()]


def test_modern_layout(spark):
    (game,) = games(spark, MODERN)
    assert (game["home_team"], game["away_team"], game["score"]) == ("A & Co", "B", "3 - 2")
    assert (game["game_time"], game["field"], game["officials"], game["table_format"]) == ("Complete", "1", "R", "modern")


def row(*cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def test_legacy_layouts(spark):
    head = '<table class="table table-striped"><tr><th>x</th></tr>'
    html = head + row("L", "A", "Sat-Feb 15", "3 - 2", "F", "V") + row("L", "A", "Sun-Feb 16", "B", "F")
    html += row("L", "A", "B", "7 PM", "V", "R") + row("L", "A", "Mon-Feb 17", "B", "F") + "</table>"
    got = [(g["home_team"], g["away_team"], g["score"], g["game_time"], g["field"]) for g in games(spark, html)]
    assert got == [("A", "", "3 - 2", "F", "V"), ("A", "B", "", "F", ""), ("A", "B", "", "7 PM", "V"),
                   ("A", "Mon-Feb 17", "", "B", "F")]


def test_day_names_are_a_parameter(spark):
    html = '<table class="table-striped"><tr></tr>' + row("L", "A", "Mon-Feb 17", "B", "F") + "</table>"
    rows = pages.table_rows(spark.createDataFrame([(1, html)], "id int, html string"), "schedule")
    assert pages.schedule_games(rows, ["Mon-"]).first().away_team == "B"


def test_events_layout_and_fallback(spark):
    table = '<table class="ezl-base-table">{}</table>'
    header = "<div><h2>Events on Saturday</h2>{}</div>"
    body = row("7", "8", "A vs B", "F1") + row("8", "9", "C - D", "F2") + row("9", "10", "Team Practice", "F3")
    got = [(g["home_team"], g["away_team"]) for g in games(spark, header.format(table.format(body)), "events")]
    assert got == [("A", "B"), ("C", "D"), ("Team Practice", "Practice")]
    plain = [(g["home_team"], g["away_team"]) for g in games(spark, table.format(body), "events")]
    assert plain == [("A", "B"), ("C - D", "Unknown"), ("Team Practice", "Unknown")]


def test_grid_layout(spark):
    html = '<table id="ctl00_ContentPlaceHolder1_gvGames"><tr><th>Date</th></tr>'
    html += row("3/7/2024", "7:05 pm", "A", "B", "F", "L") + row("13/7/2024", "7:05 PM", "A", "B", "F", "L")
    html += row("", "7:05 PM", "A", "B", "F", "L") + row("12/31/2024", "12:00 AM", "A", "B", "F", "L") + "</table>"
    assert [(g["date"], g["time"]) for g in games(spark, html, "grid")] == [
        ("2024-03-07", "07:05 PM"), ("2024-12-31", "12:00 AM"),
    ]


@pytest.mark.parametrize("layout", list(markup.LAYOUTS))
@pytest.mark.parametrize("html", ["", "no tags", "<p>x</p>", "<table", "<table><tr><td>1", "</div></div>", "<a b='c", "<!-- <table"])
def test_broken_pages_do_not_raise(layout, html):
    assert len(list(markup.LAYOUTS[layout](html))) == 0


def test_script_comment_and_entities():
    page = markup.parse("<td><!-- no --><script>var t='</p><td>'</script>a&nbsp;&lt;b <br/>c</td><td>d</td>")
    assert ["".join(c.strings()) for c in page.all("td")] == ["a <b c", "d"]


def test_self_closed_cells_are_empty():
    (row,) = [cells for _, _, cells in markup.grid_rows('<table id="ctl00_ContentPlaceHolder1_gvGames"><tr><td/><td>B</td><td a="1" />F</tr></table>')]
    assert [text for _, text in row] == ["", "B", ""]


@pytest.mark.parametrize("piece", ["<a ", "<a '", '<a "', "<a b='c'", "<!", "<", "</a "])
def test_time_grows_in_line_with_broken_pages(piece):
    import time

    def seconds(n):
        start = time.perf_counter()
        markup.parse(piece * n)
        return time.perf_counter() - start

    assert seconds(200_000) < 60 * max(seconds(10_000), 0.002)


def test_hundred_thousand_open_tags_stay_linear():
    assert len(markup.parse("<b>" * 100000 + "x").all("b")) == 100000


def test_pages_keep_their_other_columns(spark):
    stored = spark.createDataFrame([("a", 1, MODERN), ("b", 2, None)], "path string, n int, html string")
    rows = pages.table_rows(stored, "schedule")
    assert [(r.path, r.n, r.row_no) for r in rows.collect()] == [("a", 1, 1), ("a", 1, 2)]
    assert rows.select(F.size("cells").alias("n")).collect()[0].n == 7
