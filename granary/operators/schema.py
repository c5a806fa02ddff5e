"""The entry schema: fields, allowed values, and the Spark type of a typed entry."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Fixed values of the schema.
SOURCE_TEXTS = (
    "Purananuru", "Akananuru", "Kuruntokai", "Natrinai", "Divya Prabandham", "Thirumurai", "Thevaram", "Thirumanthiram", "Silappatikaram",
    "Manimekalai", "Naladiyar", "Pazhamozhi", "Deivathin Kural", "Yaeni Padigal Manthirankal",
)
PREFIXES = {
    "Purananuru": "PURN", "Akananuru": "AKAM", "Kuruntokai": "KURU", "Natrinai": "NATR", "Divya Prabandham": "DIVA", "Thirumurai": "THIR",
    "Thevaram": "THEV", "Thirumanthiram": "THIR", "Silappatikaram": "SILA", "Manimekalai": "MANI", "Naladiyar": "NALA", "Pazhamozhi": "PAZH",
    "Deivathin Kural": "DEIV", "Yaeni Padigal Manthirankal": "YAEN",
}
SANGAM = ("Purananuru", "Akananuru", "Kuruntokai", "Natrinai")
LAYERS = ("Sangam", "Bhakti", "Epic", "Didactic", "Spiritual")
DIFFICULTIES = ("archaic", "classical", "accessible")
THINAI = ("Kurinji", "Mullai", "Marutham", "Neytal", "Palai", "Kaikkilai", "Peruntinai")
AKAM_PURAM = ("Akam", "Puram")
SPEAKERS = ("talaivan", "talaivi", "tozi", "tolan", "sevili", "panan", "cevilittay", "kantor", "parattai", "virali", "passerby", "bard", "devotee", "narrator", "deity", "other")
METRES = ("venba", "aciriyappa", "kalippa", "vanjippa", "maruthipa", "viruttam", "other")
RASAS = ("Shringara", "Hasya", "Karuna", "Raudra", "Veera", "Bhayanak", "Bibhatsa", "Adbhuta", "Shanta")
NAYIKA = ("vasakasajja", "virahotkanthita", "svadhinabhartruka", "kalahantarita", "khandita", "vipralabdha", "proshitabhartruka", "abhisarika")
EMOTIONS = ("joy", "trust", "fear", "surprise", "sadness", "disgust", "anger", "anticipation")
INTENSITIES = ("low", "medium", "high")
CONFIDENCES = ("high", "medium", "low")
ID_PATTERN = r"(?U)^[A-Z]{3,4}-\d{3,4}$"
COMMENTS = {
    "_comment_core": "=== CORE LAYER: Identification & Text ===",
    "_comment_tamil_native": "=== TAMIL-NATIVE INTERPRETIVE LAYER: Tolkappiyam & Classical Tamil Poetics ===",
    "_comment_interpretive": "=== INTERPRETIVE LAYER: Thematic & Contextual Annotation ===",
    "_comment_crosscultural": "=== CROSS-CULTURAL BRIDGE LAYER: Universally Legible Annotations ===",
    "_comment_meta": "=== META: Annotation Provenance ===",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"  # string, array or object
    nullable: bool = True
    required: bool = False
    values: tuple[str, ...] = ()
    items: tuple[str, ...] = ()
    pattern: str | None = None
    min_length: int = 0


FIELDS = (
    Field("verse_id", nullable=False, required=True, pattern=ID_PATTERN),
    Field("source_text", nullable=False, required=True, values=SOURCE_TEXTS),
    Field("layer", nullable=False, required=True, values=LAYERS),
    Field("period", nullable=False),
    Field("verse_number", nullable=False, required=True),
    Field("classical_tamil", nullable=False, required=True, min_length=1),
    Field("modern_tamil"),
    Field("english"),
    Field("source_url"),
    Field("difficulty", values=DIFFICULTIES),
    Field("thinai", values=THINAI),
    Field("turai"),
    Field("akam_or_puram", values=AKAM_PURAM),
    Field("karu", "array"),
    Field("uri"),
    Field("ullurai"),
    Field("speaker_role", values=SPEAKERS),
    Field("metre", values=METRES),
    Field("pann"),
    Field("dhvani_layer"),
    Field("rasa_primary", values=RASAS),
    Field("rasa_secondary", "array", items=RASAS),
    Field("themes", "array"),
    Field("philosophical_concept"),
    Field("cultural_context"),
    Field("storytelling_seed_narrative"),
    Field("storytelling_seed_emotional"),
    Field("nayika_bheda", values=NAYIKA),
    Field("visual_imagery", "array"),
    Field("emotional_valence", "object"),
    Field("annotator"),
    Field("annotation_confidence", values=CONFIDENCES),
)
NAMES = tuple(f.name for f in FIELDS)
REQUIRED = tuple(f.name for f in FIELDS if f.required)
ANNOTATED = (
    "thinai", "turai", "akam_or_puram", "karu", "uri", "ullurai", "speaker_role", "metre", "pann", "dhvani_layer", "rasa_primary", "rasa_secondary",
    "themes", "philosophical_concept", "cultural_context", "storytelling_seed_narrative", "storytelling_seed_emotional", "nayika_bheda",
    "visual_imagery", "emotional_valence",
)
GROUPS = (
    ("Core", ("verse_id", "source_text", "layer", "period", "verse_number", "difficulty", "source_url")),
    ("Text", ("classical_tamil", "modern_tamil", "english")),
    ("Tamil-native interpretive (Tolkappiyam frame)", ("thinai", "turai", "akam_or_puram", "karu", "uri", "ullurai", "speaker_role", "metre", "pann", "dhvani_layer")),
    ("Interpretive (themes & rasa)", ("rasa_primary", "rasa_secondary", "themes", "philosophical_concept", "cultural_context", "storytelling_seed_narrative", "storytelling_seed_emotional")),
    ("Cross-cultural bridge", ("nayika_bheda", "visual_imagery", "emotional_valence")),
    ("Provenance", ("annotator", "annotation_confidence")),
)


def spark_type(f: Field) -> T.DataType:
    if f.kind == "array":
        return T.ArrayType(T.StringType())
    if f.kind == "object":
        return T.StructType([T.StructField(n, T.StringType()) for n in ("primary", "intensity", "secondary")])
    return T.StringType()


ENTRY = T.StructType([T.StructField(f.name, spark_type(f)) for f in FIELDS])

#: What each text fills in where an extractor says nothing. Fixed values.
DEFAULTS: dict[str, dict[str, str]] = {
    "Purananuru": {"layer": "Sangam", "akam_or_puram": "Puram", "speaker_role": "bard"},
    "Akananuru": {"layer": "Sangam", "akam_or_puram": "Akam"},
    "Kuruntokai": {"layer": "Sangam", "akam_or_puram": "Akam"},
    "Natrinai": {"layer": "Sangam", "akam_or_puram": "Akam"},
    "Thevaram": {"layer": "Bhakti", "speaker_role": "devotee", "rasa_primary": "Shanta"},
    "Divya Prabandham": {"layer": "Bhakti", "speaker_role": "devotee", "rasa_primary": "Shanta"},
    "Thirumanthiram": {"layer": "Spiritual", "speaker_role": "other", "rasa_primary": "Shanta"},
    "Silappatikaram": {"layer": "Epic", "speaker_role": "narrator"},
    "Manimekalai": {"layer": "Epic", "speaker_role": "narrator"},
}
ID_WIDTHS = {"Thevaram": 4, "Divya Prabandham": 4, "Thirumanthiram": 4, "Manimekalai": 4}


@dataclass(frozen=True)
class Rules:
    """What a schema file says: fields, texts that comments must have, and whether other keys are allowed."""

    fields: tuple[Field, ...]
    comments: dict[str, str]
    closed: bool = True

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)


RULES = Rules(FIELDS, COMMENTS)


def document(rules: Rules = RULES) -> str:
    """The rules as a JSON schema."""

    def prop(f: Field) -> dict:
        out: dict = {"type": [f.kind, "null"] if f.nullable else f.kind}
        if f.values:
            out["enum"] = [*f.values, *([None] if f.nullable else [])]
        if f.kind == "array":
            out["items"] = {"type": "string"} | ({"enum": list(f.items)} if f.items else {})
        return out | ({"pattern": f.pattern.removeprefix("(?U)")} if f.pattern else {}) | ({"minLength": f.min_length} if f.min_length else {})

    body = {"type": "object", "properties": {c: {"const": t} for c, t in rules.comments.items()} | {f.name: prop(f) for f in rules.fields}}
    return json.dumps(body | {"required": [f.name for f in rules.fields if f.required], "additionalProperties": not rules.closed}, ensure_ascii=False)


def read(spark: SparkSession, path: str) -> Rules:
    """The rules of a JSON schema file in any store that Spark reads: types, null, enum, pattern, minLength, items, const, required
    and additionalProperties of an object's properties. Other words are an error, so no rule is passed over silently."""
    body = json.loads(spark.read.text(path, wholetext=True).first().value)
    required, fields, comments = set(body.get("required", [])), [], {}
    for name, p in body["properties"].items():
        unknown = set(p) - {"type", "enum", "pattern", "minLength", "items", "const", "description", "properties", "required", "title"}
        if unknown:
            raise ValueError(f"{name}: {', '.join(sorted(unknown))} cannot be checked")
        if "const" in p:
            comments[name] = p["const"]
            continue
        kinds = [p["type"]] if isinstance(p["type"], str) else p["type"]
        (kind,) = [k for k in kinds if k != "null"]
        items = p.get("items", {}).get("enum", ())
        pattern = f"(?U){p['pattern']}" if "pattern" in p else None
        fields.append(Field(name, kind, "null" in kinds, name in required, tuple(v for v in p.get("enum", ()) if v is not None), tuple(items), pattern, p.get("minLength", 0)))
    return Rules(tuple(fields), comments, body.get("additionalProperties") is False)
