from pyspark.sql import functions as F

from granary.functions import headers as H
from granary.functions import text as X


def one(spark, expr, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first().r


def test_cleaning(spark):
    assert one(spark, X.block_text, "a<BR />b<i>c</i>&nbsp;d e") == "a\nbc d e"
    assert one(spark, X.clean_text, " a  b\n c ") == "a b c"
    assert one(spark, lambda c: X.clean_verse(c, "list"), "முதல் வரி  10\n1நாம்\n(3)\n-----\n\n- கபிலர்.") == "முதல் வரி\nநாம்"
    assert one(spark, lambda c: X.clean_verse(c, "table"), "வரி ஒன்று 1.1.1\nவரி 02") == "வரி ஒன்று\nவரி"
    assert one(spark, lambda c: X.clean_verse(c, "chapter"), "௧-௭. வரி ௧௦\nவரி 12") == "வரி\nவரி"
    assert one(spark, lambda c: X.clean_verse(c, "stanza"), "வரி 01-010\nவரி 5.") == "வரி\nவரி"
    assert one(spark, lambda c: X.clean_verse(c, "marked"), "வரி     5\nவரி (12) ") == "வரி\nவரி"


def test_counts(spark):
    assert one(spark, X.script_count, "abc நி x") == 2
    assert one(spark, X.script_density, "") == 0.0 and one(spark, X.script_density, "நிab") == 50.0
    assert one(spark, lambda c: X.count_literal(c, "ab"), "abab a") == 2


def test_sets(spark):
    assert one(spark, X.ngrams, "ab") == [] and one(spark, X.ngrams, "") == [] and one(spark, X.ngrams, "abab") == ["aba", "bab"]
    assert one(spark, X.ngrams, "a🎉bc") == ["a🎉b", "🎉bc"]
    assert one(spark, X.tokens, "a  b a") == ["a", "b", "a"]
    assert one(spark, lambda a, b: X.jaccard(X.tokens(a), X.tokens(b)), "", "") == 1.0
    assert one(spark, lambda a, b: X.jaccard(X.tokens(a), X.tokens(b)), "a", "") == 0.0
    assert one(spark, lambda a, b: X.jaccard(X.tokens(a), X.tokens(b)), "a b b", "b c") == 1 / 3
    assert one(spark, X.normalize, " A\\nB\n  C ") == "a b c" and one(spark, X.first_line, "A  b\nc") == "a b"


def test_lookups(spark):
    assert one(spark, lambda c: X.exact_or_hit(c, H.SETTING_NAMES), "பா‌லை.") == "Palai"
    assert one(spark, lambda c: X.exact_or_hit(c, H.SETTING_NAMES), "") is None
    assert one(spark, lambda c: X.padded_id("AB", c, 3), "7") == "AB-007" and one(spark, lambda c: X.padded_id("AB", c, 3), "1234") == "AB-1234"
    assert one(spark, lambda a, b: X.labelled([("x: ", a), ("y: ", b)]), "1", "") == "x: 1" and one(spark, lambda a: X.labelled([("x: ", a)]), None) is None


def test_markdown_and_answers(spark):
    assert one(spark, lambda c: X.markdown_value(c, "string"), "a|b") == "a\\|b" and one(spark, lambda c: X.markdown_value(c, "string"), "") == "_—_"
    assert one(spark, X.markdown_block, "a\nb") == "```\na\nb\n```" and one(spark, X.markdown_block, None) == "_—_"
    got = lambda t: one(spark, lambda c: F.to_json(X.json_in_text(c)), t)
    assert got('{"a":1}') == '{"a":1}' and got('x ```json\n{"a":2}\n``` y') == '{"a":2}' and got("```\n[1]\n```") == "[1]" and got('so {"a":3} there') == '{"a":3}'
    assert got("none") is None and got("```json\nbroken\n``` {\"a\":1}") is None
    assert one(spark, X.without_thinking, "<think>x\ny</think> answer", "z") == "answer" and one(spark, X.without_thinking, "<think>x</think>", "<THINK>q</THINK>z") == "z"
    assert one(spark, X.definition_lines, "Tamil\n\nab\n== --\nfirst meaning\n" + "w" * 600) == ["Tamil", "first meaning", "w" * 280 + "…"]
    assert one(spark, X.definition_lines, "ab") == ["ab"] and one(spark, X.definition_lines, " ") == []
    assert one(spark, X.slug, "Divya  Prabandham 1") == "divya_prabandham_"


def test_headers(spark):
    f = lambda t: tuple(one(spark, H.setting_and_genre, t))
    assert f("12. குறிஞ்சி [தோழி கூற்று.]") == ("குறிஞ்சி", "தோழி கூற்று")
    assert f("12. குறிஞ்சி.") == ("குறிஞ்சி", "")
    assert f("திணை: பாலை;\nதுறை: பிரிவு") == ("பாலை", "பிரிவு")
    a = lambda t: tuple(one(spark, H.attribution_line, t))
    assert a("திணையும் துறையும் அவை. பரணர் பாடியது.")[:2] == (H.SAME, H.SAME)
    assert a("*திணை- பாடாண்டிணை; துறை- செவியறிவுறூஉ; நாகனார் பாடியது.") == ("பாடாண்டிணை", "செவியறிவுறூஉ", "செவியறிவுறூஉ; நாகனார்", "")
    assert a("சேரமான் பெருஞ்சேரல் இரும்பொறையை மோசி கீரனார் பாடியது")[2:] == ("மோசி கீரனார்", "சேரமான் பெருஞ்சேரல் இரும்பொறையை")
    assert one(spark, H.poet_at_end, "<ul>வரி<br>- கபிலர்.") == "கபிலர்" and one(spark, H.poet_at_end, "வரி - 12.") == ""
    assert one(spark, H.poet_in_header, "குறுந்தொகை 1, திப்புத்தோளார், குறிஞ்சித் திணை") == "திப்புத்தோளார்"
    assert one(spark, H.poet_in_header, "x 1, கபிலர் குறிஞ்சி") == "கபிலர்" and one(spark, H.poet_in_header, "none") is None
    assert one(spark, H.speaker_in_header, "the hero's friend said") == "panan" and one(spark, H.speaker_in_header, "தோழி தலைவி") == "talaivi"
