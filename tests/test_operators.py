import json

from pyspark.sql import functions as F

from granary.operators import annotate, contain, dedup, lookups, match, profile, project, rules, schema, sinks, validate

GOLDEN = {
    "verse_id": "PURN-001", "source_text": "Purananuru", "layer": "Sangam", "period": "old", "verse_number": "1", "classical_tamil": "வரி", "modern_tamil": None, "english": "x",
    "source_url": None, "difficulty": "classical", "thinai": None, "turai": None, "akam_or_puram": "Puram", "karu": ["fire"], "uri": None, "ullurai": None, "speaker_role": "bard",
    "metre": "aciriyappa", "pann": None, "dhvani_layer": None, "rasa_primary": "Shanta", "rasa_secondary": ["Adbhuta"], "themes": [], "philosophical_concept": None, "cultural_context": None,
    "storytelling_seed_narrative": None, "storytelling_seed_emotional": None, "nayika_bheda": None, "visual_imagery": None,
    "emotional_valence": {"primary": "trust", "intensity": "high", "secondary": None, "extra": 1}, "annotator": None, "annotation_confidence": "medium",
}


def entry_errors(spark, *rows):
    df = spark.createDataFrame([("f", str(i), r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)], "file string, label string, json string")
    out = {}
    for r in validate.errors(df).collect():
        out.setdefault(int(r.label), []).append(r.field)
    return [sorted(out.get(i, [])) for i in range(len(rows))]


def test_golden_entry_and_each_rule(spark):
    without = lambda k: {x: v for x, v in GOLDEN.items() if x != k}
    akam = GOLDEN | {"verse_id": "AKAM-001", "source_text": "Akananuru", "akam_or_puram": "Akam", "thinai": "Palai"}
    cases = [
        (GOLDEN, []), (without("layer"), ["layer"]), (GOLDEN | {"layer": None}, ["layer"]), (GOLDEN | {"period": None}, ["period"]), (GOLDEN | {"verse_id": "purn-1"}, ["verse_id"]),
        (GOLDEN | {"verse_id": "PURN-௧௨௩"}, []), (GOLDEN | {"classical_tamil": ""}, ["classical_tamil"]), (GOLDEN | {"verse_number": 1}, ["verse_number"]), (GOLDEN | {"metre": "prose"}, ["metre"]),
        (GOLDEN | {"karu": "fire"}, ["karu"]), (GOLDEN | {"karu": ["a", None]}, ["karu"]), (GOLDEN | {"karu": ["a", 1]}, ["karu"]), (GOLDEN | {"rasa_secondary": ["Joy"]}, ["rasa_secondary"]), (GOLDEN | {"more": 1}, ["more"]),
        (GOLDEN | {"_comment_core": schema.COMMENTS["_comment_core"]}, []), (GOLDEN | {"_comment_core": "x"}, ["_comment_core"]),
        (GOLDEN | {"emotional_valence": {"primary": "trust"}}, ["emotional_valence.intensity"]), (GOLDEN | {"emotional_valence": {"primary": "calm", "intensity": "low"}}, ["emotional_valence.primary"]), (GOLDEN | {"emotional_valence": []}, ["emotional_valence"]),
        ("[1]", [""]), ("nonsense", [""]),
        (GOLDEN | {"akam_or_puram": None}, ["akam_or_puram"]), (akam, []), (akam | {"thinai": None}, ["thinai"]), (akam | {"source_text": "Thevaram", "verse_id": "THEV-0001", "layer": "Bhakti", "turai": "x"}, ["thinai", "turai"]),
        (GOLDEN | {"ullurai": "x"}, ["ullurai"]), (GOLDEN | {"ullurai": ""}, []), (GOLDEN | {"pann": "x"}, ["pann"]), (GOLDEN | {"verse_id": "AKAM-001"}, ["verse_id"]),
        (GOLDEN | {"source_text": "Naladiyar", "verse_id": "NALA-001", "layer": "Didactic", "nayika_bheda": "khandita"}, ["nayika_bheda"]),
        (GOLDEN | {"metre": "prose", "verse_id": "AKAM-001"}, ["metre"]),  # the rule is silent beside a schema error
        (GOLDEN | {"metre": "prose", "layer": "Old"}, ["layer", "metre"]),
    ]
    assert entry_errors(spark, *[c for c, _ in cases]) == [e for _, e in cases]


def test_totals_and_duplicates(spark):
    rows = [GOLDEN, GOLDEN, GOLDEN | {"verse_id": "PURN-002"}, GOLDEN | {"metre": "prose"}]
    df = spark.createDataFrame([("f", str(i), json.dumps(r)) for i, r in enumerate(rows)], "file string, label string, json string")
    assert tuple(validate.totals(df).first()) == ("f", 4, 3, 1, 1)
    assert [tuple(r) for r in validate.duplicate_ids(df).collect()] == [("f", "PURN-001", 3)]
    assert [r.ok for r in validate.first_messages(df).orderBy("label").collect()] == [True, True, True, False]


def test_rules(spark):
    df = spark.createDataFrame([(1, None), (2, -1), (3, 5)], "k int, v int")
    got = rules.breaches(df, ["k"], [("v", F.col("v") > 3, "big")], [("v", F.col("v").isNull(), "missing")])
    assert sorted(tuple(r) for r in got.collect()) == [(1, "v", "missing"), (3, "v", "big")]


def test_dedup(spark):
    df = spark.createDataFrame([("a", "", None, 1), ("a", "x", None, 2), ("a", "y", None, 3), ("b", None, [], 4), ("b", None, ["q"], 5), (None, "z", None, 6), (None, None, None, 7)], "id string, s string, l array<string>, pos int")
    best = dedup.most_complete(df, ["id"], ["s", "l"], [F.col("pos")])
    assert sorted(r.pos for r in best.collect()) == [2, 5, 6, 7]
    assert sorted(r.pos for r in dedup.most_complete(best.drop("filled"), ["id"], ["s", "l"], [F.col("pos")]).collect()) == [2, 5, 6, 7]
    assert sorted(r.pos for r in dedup.most_complete(df, ["id"], ["s", "l"], [F.col("pos")], empties=("string",), keep_keyless=False).collect()) == [2, 4]


def test_as_of(spark):
    left = spark.createDataFrame([("u", 1), ("u", 5), ("u", 9), ("v", 5)], "k string, at int")
    right = spark.createDataFrame([("u", 5, None), ("u", 7, "b"), ("u", 2, "a")], "k string, t int, title string")
    got = lambda strict: sorted((r.k, r.at, r.title, r.t) for r in lookups.as_of(left, right, ["k"], "at", "t", ["title", "t"], strict).collect())
    assert got(False) == [("u", 1, None, None), ("u", 5, None, 5), ("u", 9, "b", 7), ("v", 5, None, None)]
    assert got(True) == [("u", 1, None, None), ("u", 5, "a", 2), ("u", 9, "b", 7), ("v", 5, None, None)]


def test_ranges_gaps_and_inference(spark):
    v = spark.createDataFrame([(i,) for i in (1, 10, 11, 15, 99)], "v int")
    r = spark.createDataFrame([(0, 1, 10, "a"), (1, 10, 15, "b")], "ord int, start int, end int, label string")
    assert sorted(tuple(x) for x in lookups.first_range(v, "v", r).collect()) == [(1, "a"), (10, "a"), (11, "b"), (15, "b"), (99, None)]
    g = spark.createDataFrame([("a", i) for i in (1, 2, 4, 7)] + [("b", 3)], "k string, n int")
    assert sorted(tuple(x) for x in lookups.sequence_gaps(g, ["k"], "n").collect()) == [("a", 3), ("a", 5), ("a", 6)]
    assert lookups.sequence_gaps(g.limit(0), ["k"], "n").count() == 0
    h = spark.createDataFrame([("d", 1, 3), ("d", 2, None), ("d", 3, None), ("d", 4, 30), ("d", 5, None)], "k string, at int, n int")
    assert [(r.n, r.inferred) for r in lookups.previous_plus_one(h, ["k"], "at", "n", 30).orderBy("at").collect()] == [(3, False), (4, True), (4, True), (30, False), (None, True)]


def test_match_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("n_chars").limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, ""), (1001, None), (1002, "ab"), (1003, "ab"), (1004, "a\\nb c d"), (1005, "A b c  d"), (1006, "same line\nx y z"), (1007, "same line\nx y q"), (1008, "same line\nx y r")]
    df = spark.createDataFrame(rows, "id long, t string")
    key = lambda d: sorted((r.entry, r.idx, round(r.confidence, 9), r.match_type) for r in d.collect())
    got, want = key(match.best_matches(df, df, "id", "id", "t", "t", same_id=True)), key(match.brute_force(df, df, "id", "id", "t", "t", same_id=True))
    assert got == want and len(got) > 20 and {"exact", "first_line"} <= {g[3] for g in got}


def test_fill_and_report(spark):
    e = spark.createDataFrame([("a", "x y", None), ("b", "p q", "old"), ("c", "zzz", None)], "verse_id string, classical string, modern string")
    ref = spark.createDataFrame([(0, "x y", ""), (1, "p q", "new")], "idx int, classic string, description string")
    best = match.best_matches(e, ref, "verse_id", "idx", "classical", "classic")
    got = {r.verse_id: (r.modern, r.provenance, r.license) for r in match.fill(e, best, ref, "verse_id", "idx", "modern", "description", licence="NC").collect()}
    assert got == {"a": ("", "parallel:0", "NC"), "b": ("old", None, None), "c": (None, None, None)}
    assert {r.verse_id: r.modern for r in match.fill(e, best, ref, "verse_id", "idx", "modern", "description", overwrite=True).collect()}["b"] == "new"
    assert tuple(match.report(e, best, "verse_id").first()) == (3, 2, 0, 1, 66.7, 0.0, 33.3)
    assert tuple(match.report(e.limit(0), best, "verse_id").first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0)
    assert {r.confidence for r in match.report_rows(best, e, "verse_id", "classical", "f").collect()} == {"1.000"}


def test_containment(spark):
    d = spark.createDataFrame([(1, "xa b c dy"), (2, "a b c"), (3, "ab c d"), (4, None)], "doc_id int, text string")
    i = spark.createDataFrame([(1, "a b c d"), (2, "b"), (3, "a b c"), (4, None)], "item_id int, text string")
    want = sorted((x, k) for x, t in [(1, "xa b c dy"), (2, "a b c"), (3, "ab c d")] for k, s in [(1, "a b c d"), (2, "b"), (3, "a b c")] if s in t)
    assert sorted(tuple(r) for r in contain.contained(d, i, "doc_id", "item_id", "text").collect()) == want


def test_annotate(spark):
    e = spark.createDataFrame([("PURN-001", None, ["k"]), ("PURN-002", None, None), ("PURN-003", "Veera", ["k"]), ("PURN-004", None, ["k"])], "verse_id string, rasa_primary string, karu array<string>")

    def client(prompt):
        if "Fields: rasa_primary\n" in prompt:
            return '```json\n{"rasa_primary": "Veera"}\n```'
        return "sorry"

    good, bad = annotate.annotate(e, client, limit=3)
    assert {r.verse_id: r.rasa_primary for r in good.collect()} == {"PURN-001": "Veera", "PURN-002": None, "PURN-003": "Veera"}
    assert [tuple(r) for r in bad.collect()] == [("PURN-002", "no valid JSON found")]


def test_retries():
    calls, waits = [], []

    def flaky(p):
        calls.append(p)
        if len(calls) < 3:
            raise annotate.Failed(503, 7)
        return "ok"

    assert annotate.with_retries(flaky, "p", pause=waits.append) == "ok" and len(waits) == 2 and all(7 <= w <= 7.5 for w in waits)
    assert annotate.with_retries(lambda p: (_ for _ in ()).throw(annotate.Failed(400)), "p", pause=waits.append) is None and len(waits) == 2


def test_patch(spark):
    e = spark.createDataFrame([("a", "old", ["x"])], "verse_id string, english string, karu array<string>")
    p = e.withColumn("patch", F.parse_json(F.lit('{"english": null, "karu": ["y"], "unknown": 1}')))
    r = annotate.merged(p, "patch").first()
    assert (r.english, r.karu) == (None, ["y"])
    assert [x.e for x in p.select(validate.annotation_errors("patch").alias("e")).collect()] == [[]]
    bad = e.withColumn("patch", F.parse_json(F.lit('{"rasa_primary": "x", "karu": "y", "emotional_valence": {"primary": "joy"}}')))
    assert len(bad.select(validate.annotation_errors("patch").alias("e")).first().e) == 3
    assert e.select(validate.null_fields(e).alias("n")).first().n == []


def test_project_and_markdown(spark):
    d = spark.createDataFrame([("7", "வரி\nவரி")], "number string, text string")
    e = project.to_entries(d, "Thevaram", values={"classical_tamil": F.col("text")}, context=[("Pann: ", F.lit("x"))])
    r = e.first()
    assert (r.verse_id, r.layer, r.cultural_context, r.rasa_primary) == ("THEV-0007", "Bhakti", "Pann: x", "Shanta")
    md = e.select(sinks.markdown_entry(e).alias("m")).first().m
    assert md.startswith("### THEV-0007\n\n**Source Text:** Thevaram | **Layer:** Bhakti | **Verse Number:** 7\n") and "```\nவரி\nவரி\n```" in md and "- **Karu:** _—_" in md
    doc = sinks.markdown_documents(e, "source_text", ["verse_id"]).first().markdown
    assert doc.startswith("# Thevaram\n\n**Total entries:** 1\n")
    assert json.loads(sinks.json_array(e, ["verse_id"]).first().json)[0]["english"] is None


def test_html_profile(spark):
    h = "<h1>1. One</h1><h2>x</h2><ul>a (N)</ul><ul>b</ul><p>(12) (3)</p><hr><br> <br>***—"
    p = profile.html_profile(spark.createDataFrame([(1, h)], "id int, html string"), "html", ["id"]).first()
    assert (p.n_h1, p.n_ul, p.n_hr, p.n_br_br, p.n_numbers, p.number_samples, p.n_end_markers, p.n_lists_with_marker, p.n_numbered_headings, p.n_dashes, p.n_asterisks) == (1, 2, 1, 1, 2, ["(12)", "(3)"], 1, 1, 1, 1, 1)
    assert p.samples_h1 == ["1. One"]


def test_entries_are_parsed_once_and_spread(spark):
    """a filter by the number of breaches made every rule parse the entry, in the task of the file."""
    df = spark.createDataFrame([("f", "1", json.dumps(GOLDEN | {"layer": None}))], "file string, label string, json string")
    plan = validate.errors(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 2 and plan.index("parse") < plan.index("Repartition")
    assert [r.field for r in validate.errors(df).collect()] == ["layer"]
