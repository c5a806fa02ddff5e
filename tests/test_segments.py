import re

from pyspark.sql import functions as F

from granary.operators import scan, segment

T = "தமிழ் வரி ஒன்று இரண்டு மூன்று நான்கு ஐந்து ஆறு ஏழு"  # over 30 letters


def page(spark, html, **more):
    return spark.createDataFrame([(1, html, *more.values())], "id int, html string" + "".join(f", {k} {'int' if isinstance(v, int) else 'string'}" for k, v in more.items()))


def test_split_drops_nothing(spark):
    h = "head<p>a<p>b<p>"
    rows = spark.createDataFrame([(h,)], "html string").select(F.posexplode(F.split("html", "(?=<p>)"))).collect()
    assert "".join(r.col for r in rows) == h


def test_heading_longest_list(spark):
    h = f"<h3>செய்யுள் 1</h3>திணை: பாலை<ul>{T[:20]}</ul><ul>{T}<br>{T}</ul><ul>{T} உரை</ul><h3>செய்யுள் 2</h3><ul>short</ul><h3>செய்யுள் 3</h3><ul>{T} அ</ul><ul>{T} ஆ</ul>"
    got = segment.heading_longest_list(page(spark, h), "html", ["id"]).orderBy("number").collect()
    assert [(r.number, r.tinai, r.text) for r in got] == [("1", "பாலை", f"{T}\n{T}"), ("3", "", f"{T} அ")]


def test_bold_number_list(spark):
    h = f"<strong>5. no</strong><strong>101. குறிஞ்சி<br>[கூற்று.]<ul><strong>{T}</strong> 10<br>- கபிலர்.</ul><strong>7. inner</strong><strong>102. பாலை</strong>none"
    got = [(r.number, r.tinai, r.turai, r.poet, r.text) for r in segment.bold_number_list(page(spark, h), "html", ["id"]).collect()]
    assert got == [("101", "குறிஞ்சி", "கூற்று", "கபிலர்", T)]


def test_table_rows(spark):
    cell = lambda n: f"<tr><td valign=top>{n}. <td>{T}<br>{T} 1.2.3 <td valign='bottom'>2.3.{n}</tr>"
    h = f"<h3>1.1 other <</h3>{cell(9)}<h3><font color=blue>2.3. Title. </font></h3><b>பண் - இந்தளம்</b>{cell(1)}{cell(2001)}{cell(2)}<h3>2.4 Next</h3>{cell(3)}"
    got = segment.table_rows(page(spark, h, part=2), "html", ["id"], "part", {2: 1469}).orderBy("global_number").collect()
    assert [(r.section, r.title, r.tune, r.number, r.global_number) for r in got] == [("2.3", "Title", "இந்தளம்", "1", 1470), ("2.3", "Title", "இந்தளம்", "2", 1471), ("2.4", "Next", "", "3", 1472)]
    assert got[0].text == f"{T}\n{T}"


def test_bilingual(spark):
    t = f"intro see X 9, none{' ' * 260}X 1, கபிலர், குறிஞ்சித் திணை – தலைவி சொன்னது\n{T}  5\n{T}\nstray English line here\nKurun 1, Kapilar\nA song.\nNotes: n1\nX 1, again திணை X 2, பரணர், பாலை – தோழி கூறியது{T}"
    blocks = segment.real_headers(page(spark, t), "html", ["id"], "X")
    assert [r.number for r in blocks.orderBy("pos").collect()] == [1, 2]
    got = segment.bilingual(blocks, ["id"], ["Kurun", "Kuru"]).orderBy("number").collect()
    assert (got[0].poet, got[0].tinai, got[0].speaker_role, got[0].dramatic_context) == ("கபிலர்", "Kurinji", "talaivi", "தலைவி சொன்னது")
    assert got[0].classical_tamil == f"{T}\n{T}" and got[0].english == "A song." and got[0].notes.startswith("n1")
    assert (got[1].classical_tamil, got[1].english, got[1].speaker_role) == (T, None, "tozi")


def test_titles_and_ranges(spark):
    h = "ab<h3>One <b>x</b></h3>cd<strong>1.. Sub.</strong><strong></strong><h3>முதல் (113-336)</h3><h3>Other (5 – 9)</h3>"
    got = [(r["at"], r.title) for r in segment.section_titles(page(spark, h), "html", ["id"]).orderBy("at").collect()]
    assert got == [(m.start(), re.sub("<[^>]+>", "", m[0])) for m in re.finditer(r"<h3>.*?</h3>|<strong>[^<]+</strong>", h)]
    assert [(r["at"], r.title) for r in segment.subsection_titles(page(spark, h), "html", ["id"]).collect()] == [(h.index("<strong>1"), "Sub")]
    assert [(r.start, r.end, r.label) for r in segment.numbered_ranges(page(spark, h), "html", ["id"], scan.BOOK_LABELS).orderBy("ord").collect()] == [(113, 336, "Tantra 1"), (5, 9, "Other")]


def rows_of(spark, f, html, *columns, **more):
    """The rows that a reader finds on one page, in order."""
    out = f(page(spark, html, **more), "html", ["id"], *(["name"] if "name" in more else []))
    got = [r.asDict() for r in out.collect()]
    return [tuple(r[c] for c in columns) for r in sorted(got, key=lambda r: (r.get("pos", 0), int(r["number"]), r.get("k", 0)))]


def test_number_lines_do_not_overlap(spark):
    h = f"<h3>Head</h3><br>5<br>6<br>{T}<br>5<br>{T} again<br>9000<br>x<h3>Next</h3><strong>S</strong><br>7:<br>{T} 1.1.3<hr>{T}"
    got = rows_of(spark, scan.number_lines, h, "number", "section", "text")
    assert [g[:2] for g in got] == [("5", "Head"), ("7", "S")] and got[0][2].endswith(T) and got[1][2] == T
    assert rows_of(spark, scan.number_lines, f"<br>5<br>{T}", "number", name="Divya_Prabandham_Iramanusa_1.html") == []
    assert rows_of(spark, scan.number_lines, f"<br>5<br>{T}", "number", name="raw/a.html") == [("5",)]


def test_dotted_lines(spark):
    h = f"<h3>முதல் (1-5)</h3><strong>1.. Sub.</strong><br>2.<br>{T} 2<br>\n3. <br>{T}<strong>x</strong>{T}<br>2.<br>{T} second"
    assert rows_of(spark, scan.dotted_lines, h, "number", "title", "section", "text") == [("2", "Tantra 1", "Sub", T), ("3", "Tantra 1", "Sub", T)]


def test_chapters_skip_the_contents(spark):
    toc = "".join(f"<br>{n}. பாடல் {n}" for n in range(1, 5)) + "<br>"
    body = f"{'-' * 400}<br>1. மங்கல பாடல்<br><ul>{T} {T}</ul><h3>2. காதை</h3><ul>{T}</ul><ul>{T} {T} 12</ul><h3>13. x</h3><br>2. வரி two<br><ul>{T * 4}</ul>"
    letters = lambda s: sum("஀" <= c <= "௿" for c in s)
    assert rows_of(spark, scan.chapters, toc + body, "number", "title", "text") == [("1", "மங்கல பாடல்", f"{T} {T}"), ("2", "காதை", max((f"{T} {T}", T * 4), key=letters))]


def test_stanzas_infer_chapters(spark):
    row = lambda c, n: f"<tr><td>{T} {c:02d}-{n:03d}<br>{T}<td valign=bottom> {c:02d}-{n:03d}</tr>"
    h = f"{row(0, 10)}{row(1, 1)}<h3>1. One</h3>{row(1, 20)}{row(2, 5)}<h3>காதை Two</h3>{row(2, 30)}<h3>காதை Three</h3>{row(2, 40)}{row(3, 1)}"
    assert rows_of(spark, scan.stanzas, h, "number", "title", "line_end") == [("00", scan.PROLOGUE, "010"), ("01", "One", "020"), ("02", "காதை Two", "030"), ("02", "காதை Three", "040")]
    assert rows_of(spark, scan.stanzas, row(0, 1), "number") == [] and rows_of(spark, scan.stanzas, f"<h3>1. One</h3>{row(1, 2)}", "number", name="X_Summary.html") == []


def test_named_lines(spark):
    h = f"\n303. பாலை.<br>[துறை.]<br>{T} 5<br>{T}<br>(உரை)<br>{T}<br>------<br>{T}<br>\n304. குறிஞ்சி<br>x<br>\n303. மருதம்<br>{T}"
    assert rows_of(spark, scan.named_lines, h, "number", "tinai", "turai", "text") == [("303", "பாலை", "துறை", f"{T}\n{T}")]
    found = spark.createDataFrame([(1, "303")], "id int, number string")
    assert scan.named_lines(page(spark, h), "html", ["id"], found).count() == 0


def test_marked_lists(spark):
    h = f"<center><h3>2. Title.</h3></center>A prose introduction.<br><ul>{T}     5<br>{T} (2)</ul>திணை: பாலை; x<strong>உரை</strong>: gloss<br>more<strong>விளக்கம்</strong>why<br>------<br>after<ul>no marker</ul>"
    columns = ("number", "title", "header_line", "prose", "commentary", "explanation")
    assert rows_of(spark, scan.marked_lists, h, *columns) == [("2", "Title", "திணை: பாலை; x", "A prose introduction.", ": gloss more", "why")]


def test_bold_numbers(spark):
    h = f"<strong>201. Title.</strong><br>prose<br>------<br><ul>first</ul><ul>{T}</ul>திணை: பாலை<br>உரை: gloss<br>விளக்கம் : why<br>-----<br>gone<strong>202</strong>none"
    columns = ("number", "title", "text", "header_line", "prose", "commentary", "explanation")
    assert rows_of(spark, scan.bold_numbers, h, *columns) == [("201", "Title", T, "திணை: பாலை", "prose", "gloss", "why")]


def test_null_and_empty_pages_have_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "plain")], "id int, html string")
    for f in (scan.number_lines, scan.dotted_lines, scan.chapters, scan.stanzas, scan.named_lines, scan.marked_lists, scan.bold_numbers):
        assert f(df, "html", ["id"]).count() == 0
