"""Checking entries: every breach is a row (label, field, message).

Entries are checked as JSON text, since a missing key and a null differ. Cross-field rules run only
on entries without a schema error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import strip
from granary.operators import schema as S


#: What ``parsed`` adds.
PARSED = ("v", "keys", "kinds", "texts")


def parsed(df: DataFrame, json: str = "json") -> DataFrame:
    """Adds ``v``, the entry as a variant (null if it does not parse), ``keys``, and by key ``kinds`` and ``texts``: each value is
    looked at once, not once for every rule. Checking costs far more than moving an entry, and one file may be one task's."""
    plain = [c for c, kind in df.dtypes if kind in ("string", "int", "bigint")]
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *plain)
    df = df.withColumn("v", F.try_parse_json(F.col(json))).withColumn("keys", F.json_object_keys(F.when(F.col("v").isNotNull(), F.col(json))))
    values = F.try_variant_get(F.col("v"), "$", "map<string,variant>")
    return df.withColumns({"kinds": F.transform_values(values, lambda _, x: F.schema_of_variant(x)), "texts": F.transform_values(values, lambda _, x: F.try_variant_get(x, "$", "string"))})


def kind_of(path: str) -> Column:
    """STRING, BIGINT, BOOLEAN, VOID (a JSON null), ARRAY<..>, OBJECT<..>; null if missing."""
    name = path.removeprefix("$.")
    return F.col("kinds")[name] if "." not in name else F.schema_of_variant(F.try_variant_get(F.col("v"), path, "variant"))


def text_of(path: str) -> Column:
    name = path.removeprefix("$.")
    return F.col("texts")[name] if "." not in name else F.try_variant_get(F.col("v"), path, "string")


def _error(field: str, message: Column | str) -> Column:
    return F.struct(F.lit(field).alias("field"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def _enum(c: Column, values: tuple[str, ...]) -> Column:
    return c.isin(*values)


def field_errors(f: S.Field) -> list[Column]:
    path = f"$.{f.name}"
    k, x = kind_of(path), text_of(path)
    there = F.array_contains("keys", f.name)
    out = []
    if f.required:
        out.append(F.when(~there, _error(f.name, f"'{f.name}' is a required property")))
    right = {"string": k == "STRING", "array": k.startswith("ARRAY"), "object": k.startswith("OBJECT")}[f.kind]
    allowed = (right | (k == "VOID")) if f.nullable else right
    out.append(F.when(there & ~F.coalesce(allowed, F.lit(False)), _error(f.name, f"is not of type '{f.kind}'" + (" or null" if f.nullable else ""))))
    if f.values:
        out.append(F.when(there & (k == "STRING") & ~_enum(x, f.values), _error(f.name, F.concat(F.lit("'"), x, F.lit("' is not one of the allowed values")))))
    if f.pattern:
        out.append(F.when(there & (k == "STRING") & ~x.rlike(f.pattern), _error(f.name, F.concat(F.lit("'"), x, F.lit("' does not match the pattern")))))
    if f.min_length:
        out.append(F.when(there & (k == "STRING") & (F.length(x) < f.min_length), _error(f.name, "is too short")))
    if f.kind == "array":
        # An array of one kind only: a mixed one, or one that holds nulls, has VARIANT or VOID items.
        good = k.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.coalesce(F.exists(F.try_variant_get(F.col("v"), path, "array<string>"), lambda i: i.isNull()), F.lit(False))
        out.append(F.when(k.startswith("ARRAY") & ~good, _error(f.name, "has an item that is not of type 'string'")))
        if f.items:
            bad = F.exists(F.try_variant_get(F.col("v"), path, "array<string>"), lambda i: i.isNotNull() & ~_enum(i, f.items))
            out.append(F.when((k == "ARRAY<STRING>") & bad, _error(f.name, "has an item that is not one of the allowed values")))
    if f.name == "emotional_valence":
        for part, values, required, nullable in (("primary", S.EMOTIONS, True, False), ("intensity", S.INTENSITIES, True, False), ("secondary", S.EMOTIONS, False, True)):
            pk, px, name = kind_of(f"{path}.{part}"), text_of(f"{path}.{part}"), f"emotional_valence.{part}"
            if required:
                out.append(F.when(k.startswith("OBJECT") & pk.isNull(), _error(name, f"'{part}' is a required property")))
            fine = (pk == "STRING") & _enum(px, values)
            out.append(F.when(k.startswith("OBJECT") & pk.isNotNull() & ~F.coalesce((fine | (pk == "VOID")) if nullable else fine, F.lit(False)), _error(name, "is not one of the allowed values")))
    return out


def schema_errors(rules: S.Rules = S.RULES) -> Column:
    """array<struct(field, message)> of the schema's breaches, in order of the field's name."""
    known = [*rules.names, *rules.comments]
    unknown = F.transform(F.filter("keys", lambda k: ~k.isin(*known)), lambda k: F.struct(k.alias("field"), F.lit("is not an allowed property").alias("message")))
    comments = [F.when(F.array_contains("keys", k) & ~F.coalesce(text_of(f"$.{k}") == v, F.lit(False)), _error(k, "was expected to be a fixed text")) for k, v in rules.comments.items()]
    found = F.array_compact(F.array(*[e for f in rules.fields for e in field_errors(f)], *comments))
    none = F.array().cast("array<struct<field:string,message:string>>")
    everything = F.array_sort(F.concat(found, F.coalesce(unknown, none) if rules.closed else none))
    not_an_object = F.array(_error("", "is not a JSON object"))
    return F.when(F.col("keys").isNull(), not_an_object).otherwise(everything)


def _has(name: str) -> Column:
    """Whether a field holds something: empty texts and lists do not."""
    k = kind_of(f"$.{name}")
    return F.coalesce((k != "VOID") & ~((k == "STRING") & (text_of(f"$.{name}") == "")), F.lit(False))


def cross_field_errors() -> Column:
    """Rules between fields."""
    source, layer, ap = text_of("$.source_text"), text_of("$.layer"), text_of("$.akam_or_puram")
    sangam = F.coalesce(source.isin(*S.SANGAM), F.lit(False))
    expected = F.coalesce(*[F.when(source == k, F.lit(v)) for k, v in S.PREFIXES.items()])
    actual = F.split(text_of("$.verse_id"), "-")[0]
    other_layer = lambda *xs: ~F.coalesce(layer.isin(*xs), F.lit(False))
    ev = kind_of("$.emotional_valence")
    rules = [
        ("akam_or_puram", sangam & ~_has("akam_or_puram"), "a text of the Sangam layer should say Akam or Puram"),
        ("thinai", sangam & (ap == "Akam") & ~_has("thinai"), "an Akam poem should have a thinai"),
        ("thinai", _has("thinai") & other_layer("Sangam"), "only texts of the Sangam layer have a thinai"),
        ("turai", _has("turai") & other_layer("Sangam"), "only texts of the Sangam layer have a turai"),
        ("ullurai", _has("ullurai") & (ap == "Puram"), "an ullurai is unusual in Puram poems"),
        ("nayika_bheda", _has("nayika_bheda") & (layer == "Didactic"), "does not apply to the Didactic layer"),
        ("pann", _has("pann") & other_layer("Bhakti", "Spiritual"), "is unusual outside the Bhakti and Spiritual layers"),
        ("emotional_valence", ev.isNotNull() & (ev != "VOID") & ~ev.startswith("OBJECT"), "must be an object with primary and intensity"),
        ("emotional_valence.primary", ev.startswith("OBJECT") & kind_of("$.emotional_valence.primary").isNull(), "is missing"),
        ("emotional_valence.intensity", ev.startswith("OBJECT") & kind_of("$.emotional_valence.intensity").isNull(), "is missing"),
        ("verse_id", _has("verse_id") & (actual != expected), "does not begin with the text's prefix"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(when, F.lit(False)), _error(field, message)) for field, when, message in rules]))


def errors(df: DataFrame, json: str = "json", label: str = "label", file: str = "file", rules: S.Rules = S.RULES) -> DataFrame:
    """file, label, field, message of every breach; ``rules`` may come from a schema file (``schema.read``)."""
    checked = parsed(df, json).withColumn("_s", schema_errors(rules)).withColumn("_e", F.when(F.size("_s") > 0, F.col("_s")).otherwise(cross_field_errors()))
    # An inner inline would filter by the size of _e below all this, with every rule parsing the entry for itself once more.
    return checked.select(file, label, F.inline_outer("_e")).where("field is not null")


def totals(df: DataFrame, json: str = "json", file: str = "file") -> DataFrame:
    """file, entries, passed, errors, duplicate_ids; an id that repeats does not fail its entries."""
    checked = parsed(df, json).withColumn("_s", schema_errors()).withColumn("_e", F.when(F.size("_s") > 0, F.col("_s")).otherwise(cross_field_errors()))
    per_id = checked.groupBy(file, text_of("$.verse_id").alias("_id")).agg(F.count("*").alias("_n"), F.count_if(F.size("_e") == 0).alias("_p"), F.sum(F.size("_e")).alias("_errors"))
    return per_id.groupBy(file).agg(F.sum("_n").alias("entries"), F.sum("_p").alias("passed"), F.sum("_errors").alias("errors"), F.count_if(F.col("_id").isNotNull() & (F.col("_n") > 1)).alias("duplicate_ids"))


def duplicate_ids(df: DataFrame, json: str = "json", file: str = "file") -> DataFrame:
    rows = parsed(df, json).select(file, text_of("$.verse_id").alias("verse_id")).where("verse_id is not null")
    return rows.groupBy(file, "verse_id").agg(F.count("*").alias("n")).where("n > 1")


def first_messages(df: DataFrame, json: str = "json", most: int = 3) -> DataFrame:
    """Schema conformance alone: ok, and the first messages joined."""
    checked = parsed(df, json).withColumn("_s", schema_errors())
    return checked.withColumn("ok", F.size("_s") == 0).withColumn("messages", F.array_join(F.transform(F.slice("_s", 1, most), lambda e: F.concat_ws(": ", e.field, e.message)), "; ")).drop("_s", *PARSED)


def null_fields(df: DataFrame, fields: tuple[str, ...] = S.ANNOTATED) -> Column:
    """Names of the fields still to annotate: null or an empty list; an empty text counts as filled."""
    kinds = dict(df.dtypes)
    return F.array_compact(F.array(*[F.when(F.col(f).isNull() | ((F.size(f) == 0) if kinds[f].startswith("array") else F.lit(False)), F.lit(f)) for f in fields if f in kinds]))


def annotation_errors(patch: str = "patch") -> Column:
    """What is wrong with an annotation, given as a variant column."""
    v = F.col(patch)
    kind = lambda p: F.schema_of_variant(F.try_variant_get(v, p, "variant"))
    text = lambda p: F.try_variant_get(v, p, "string")
    given = lambda p: kind(p).isNotNull() & (kind(p) != "VOID")
    out = []
    for name, values in (("rasa_primary", S.RASAS), ("nayika_bheda", S.NAYIKA)):
        out.append(F.when(given(f"$.{name}") & ~F.coalesce(text(f"$.{name}").isin(*values), F.lit(False)), F.lit(f"{name}: not an allowed value")))
    for name in ("rasa_secondary", "karu", "themes", "visual_imagery"):
        out.append(F.when(given(f"$.{name}") & ~kind(f"$.{name}").startswith("ARRAY"), F.lit(f"{name}: must be an array")))
    items = F.try_variant_get(v, "$.rasa_secondary", "array<string>")
    out.append(F.when(F.exists(items, lambda i: ~F.coalesce(i.isin(*S.RASAS), F.lit(False))), F.lit("rasa_secondary: an item is not an allowed value")))
    ev = kind("$.emotional_valence")
    out.append(F.when(given("$.emotional_valence") & ~ev.startswith("OBJECT"), F.lit("emotional_valence: must be an object")))
    for part, values in (("primary", S.EMOTIONS), ("intensity", S.INTENSITIES)):
        p = f"$.emotional_valence.{part}"
        out.append(F.when(ev.startswith("OBJECT") & kind(p).isNull(), F.lit(f"emotional_valence.{part}: missing")))
        out.append(F.when(ev.startswith("OBJECT") & kind(p).isNotNull() & ~F.coalesce(text(p).isin(*values), F.lit(False)), F.lit(f"emotional_valence.{part}: not an allowed value")))
    return F.array_compact(F.array(*out))


def request_errors(fields: tuple[str, ...], target: str | None = None, targets: tuple[str, ...] = ("modern_tamil", "english")) -> Column:
    """What a request lacks."""
    out = [F.when(F.coalesce(strip(F.col(f).cast("string")), F.lit("")) == "", F.lit(f"missing {f}")) for f in fields]
    if target:
        out.append(F.when(~F.coalesce(F.col(target).isin(*targets), F.lit(False)), F.lit(f"invalid {target}")))
    return F.array_compact(F.array(*out))
