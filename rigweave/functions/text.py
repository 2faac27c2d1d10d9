"""Controlled task language, intents, redaction and naming, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits, phrases and patterns of the controlled task language.
MAX_LENGTH, MIN_LENGTH, SCHEMA_MAX_LENGTH = 160, 4, 240
FORBIDDEN_PREFIXES = (
    "the robot", "the robotic", "the arm", "the hand is", "it seems", "it appears", "we can see", "in this image", "in this frame", "in the image",
    "according to", "i think", "i guess", "maybe", "perhaps", "probably", "possibly", "looks like", "seems like",
)
SPECULATIVE_WORDS = ("appears to", "seems to", "seems like", "might be", "may be")
ACTUATOR_PATTERNS = (
    r"\bjoint\s*\d+\b", r"\bqpos\b", r"\bqcmd\b", r"\bjoints?\b.*\b(rotat|move|flex|bend|extend)\w*", r"\bservo\b", r"\bmotor\b", r"\bactuator\b",
    r"\bgripper (command|position|target)\b", r"\b(degrees?|deg|radians?)\b", r"\b17d\b", r"\b1[76][- ]?d(im(ensional)?)?\b",
)
EMBODIMENT_PATTERNS = (
    r"^(?:move|rotate|position|orient|raise|lower)\s+(?:the\s+)?(?:robot(?:ic)?\s+)?(?:arm|hand|wrist|end[- ]effector|gripper)\b",
    r"^(?:reach|extend)\s+(?:the\s+)?(?:robot(?:ic)?\s+)?(?:arm|hand|wrist|end[- ]effector|gripper)\b",
)
EVALUATIVE_WORDS = ("successfully", "correctly", "perfectly", "carefully", "slowly", "precisely")
PRONOUN_PATTERNS = (r"\b(?:pick|move|insert|place|grasp|lift|hold|release|press)\s+(?:it|them|this|that)\b",)
MARKDOWN_PATTERN = r"[*#`_{}\[\]]|^\s*[-+]\s"
ACTUATOR_WORDS = ("joint", "joints", "motor", "motors", "actuator", "servo", "qpos", "qcmd", "radian", "关节", "电机", "执行器")
INTENT_PATTERNS = {
    "APPROACH": (r"\breach\b", r"\bapproach\b"),
    "ACQUIRE": (r"\bgrasp\b", r"\bpick(?: up)?\b", r"\btake\b", r"\breceive\b", r"\bhold\b"),
    "TRANSPORT": (r"\bmove\b", r"\bcarry\b", r"\btransfer\b", r"\blift\b"),
    "ALIGN": (r"\balign\b", r"\bposition\b", r"\borient\b"),
    "INSERT_CONNECT": (r"\binsert\b", r"\bplug\b", r"\bconnect\b", r"\bseat\b"),
    "RELEASE": (r"\brelease\b", r"\bplace\b", r"\bset down\b"),
    "ACTUATE": (r"\bpress\b", r"\bpush\b", r"\bpull\b", r"\bturn\b", r"\bopen\b", r"\bclose\b"),
}
SECRET_PATTERNS = (
    (r"hf_[A-Za-z0-9]{10,}", "[REDACTED]"),
    (r"(?i)Bearer\s+[^\s\"']+", "Bearer [REDACTED]"),
    (r"(?i)(Authorization\s*[:=]\s*)[^\s\"']+", "$1[REDACTED]"),
    (r"(?i)\b([A-Z0-9_]*(?:TOKEN|SECRET|PASSWORD|API_KEY))\s*=\s*[^\s]+", "$1=[REDACTED]"),
)
# End of the fixed values.


def _any(patterns: tuple[str, ...]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


#: Class of each violation, in the order in which they are reported, with the pattern over the lower-cased text.
VIOLATION_PATTERNS = (
    ("NARRATIVE_OR_SPECULATIVE_PREFIX", "^(?:" + "|".join(FORBIDDEN_PREFIXES) + ")"),
    ("SPECULATIVE_WORDING", _any(SPECULATIVE_WORDS)),
    ("ACTUATOR_NARRATION", _any(ACTUATOR_PATTERNS)),
    ("EMBODIMENT_CENTRIC_LANGUAGE", _any(EMBODIMENT_PATTERNS)),
    ("EVALUATIVE_WORDING", r"\b(?:" + "|".join(EVALUATIVE_WORDS) + r")\b"),
    ("UNNAMED_PRONOUN_OBJECT", _any(PRONOUN_PATTERNS)),
    ("MARKDOWN_OR_STRUCTURE", MARKDOWN_PATTERN),
)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def normalize_instruction(text: Column) -> Column:
    """Outer space and final full stops go, inner space becomes single blanks."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"\.+$", ""), r"\s+", " "))


def violations(text: Column) -> Column:
    """Classes the text violates, once each, in a fixed order; null and blank texts are EMPTY_INSTRUCTION."""

    def judge(low: Column) -> Column:
        found = [F.when(low.rlike(pattern), F.lit(name)) for name, pattern in VIOLATION_PATTERNS]
        length = F.when((F.length(low) > MAX_LENGTH) | (F.length(low) < MIN_LENGTH), F.lit("INSTRUCTION_LENGTH"))
        return F.when(low.isNull() | (low == ""), F.array(F.lit("EMPTY_INSTRUCTION"))).otherwise(F.array_compact(F.array(*found, length)))

    # bound as a lambda's variable, the lower-cased text is made once and not once a pattern
    return F.transform(F.array(F.lower(strip(text))), judge)[0]


def intents(text: Column) -> Column:
    """Sorted broad intent classes that the wording names."""
    low = F.lower(text)
    return F.array_sort(F.array_compact(F.array(*[F.when(low.rlike(_any(p)), F.lit(name)) for name, p in INTENT_PATTERNS.items()])))


def actuator_words(text: Column) -> Column:
    """Actuator words that the text uses as whole words (or anywhere, for Chinese ones), sorted."""
    words = F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.regexp_replace(w, r'^[.,:;!?()\[\]{}"]+|[.,:;!?()\[\]{}"]+$', ""))
    latin = F.array_intersect(words, F.array(*[F.lit(w) for w in ACTUATOR_WORDS if w.isascii()]))
    han = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in ACTUATOR_WORDS if not w.isascii()]))
    return F.array_sort(F.array_distinct(F.concat(latin, han)))


def redact(text: Column) -> Column:
    """Tokens, bearer and authorization values and secret assignments replaced."""
    for pattern, by in SECRET_PATTERNS:
        text = F.regexp_replace(text, pattern, by)
    return text


def episode_name(number: Column) -> Column:
    return F.format_string("episode_%06d", number)


def frame_path(chunk_size: int, index: Column) -> Column:
    """Where a frame table of episode `index` lies."""
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(index / chunk_size).cast("long"), index)


def episode_number(ident: Column, path: Column) -> Column:
    """The episode's number from any spelling of its id, else from the path's last directory; null if neither tells."""

    def number(text: Column) -> Column:
        # the last run of digits that no letter follows inside the file stem: 'episode-7', '/x/episode_7.npz', 'episode_7_media', '7'
        stem = F.regexp_extract(F.lower(F.trim(text)), r"([^/\\]*)[/\\]*$", 1)
        return F.regexp_extract(stem, r"^\D*?(\d+)(?:\D.*)?$", 1)

    found = F.coalesce(F.nullif(number(ident), F.lit("")), F.nullif(number(path), F.lit("")))
    return found.cast("long")


def canonical_object(fields: dict[str, Column], schema: T.StructType, item: str = ", ", colon: str = ": ") -> Column:
    """One JSON object with its keys in order and fixed separators, so that equal values give equal bytes; nulls stay as null.

    Values are texts (as in JSON, not reduced to ASCII), whole numbers and booleans, of the types that `schema` gives them;
    others are refused, as their spelling is not fixed.
    """
    parts = []
    for name in sorted(fields):
        kind = schema[name].dataType
        if not isinstance(kind, T.StringType | T.LongType | T.IntegerType | T.BooleanType):
            raise TypeError(f"no canonical spelling for {name}: {kind.simpleString()}")
        inner = F.to_json(F.array(fields[name]))
        value = F.substring(inner, F.lit(2), F.length(inner) - 2)
        parts.append(F.concat(F.lit(f'"{name}"{colon}'), F.coalesce(F.when(fields[name].isNotNull(), value), F.lit("null"))))
    return F.concat(F.lit("{"), F.concat_ws(item, *parts), F.lit("}"))
