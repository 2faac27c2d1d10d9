"""Texts that were cut off (problem 8): a self-join by prefix.

A text is read as units, the sentences and lines it consists of. A unit that breaks off is a strict prefix of what longer
copies of its wording say elsewhere. So every prefix of every unit, cut at word boundaries, is hashed, and for each
prefix in question the words that follow it anywhere are counted, with how often the unit ended there. The last unit of a
text without a closing mark is then cut if elsewhere its wording goes on and (next to) never ends there. Besides whole
unit prefixes, the last four and two words serve as prefixes where a whole one is too rare to tell.

An open structure (JSON without its end, a bracket that the last unit leaves open, a half character) needs no join.
Signatures and other trailing lines are known by recurring as the end of many texts; the content before them is judged as
well. Every text found says by which of these ways (`why`).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigweave.session import settle

TOKEN = re.compile(r"[㐀-鿿]|[^\s㐀-鿿]+")
HAN = re.compile(r"[㐀-鿿]")
CLOSERS = "\"'”’»)]}」』）】"
ENDS = ".!?。！？"
SENTENCE = re.compile(r"(?<=[.!?])[" + re.escape(CLOSERS) + r"]*\s+|(?<=[。！？])")
#: Bits (as a power of two) of the filter of places looked up, which all tasks get: 2 MB whatever the number of lookups.
FILTER_BITS = 24
#: Words are matched by their first letters, at most so many, and then compared whole.
STEM = 64
#: So many copies need no second opinion.
FIRM = 12
#: A word that goes on so often, and so many times oftener than it ends, ends no text.
OFTEN = 50
MARKER = re.compile(r"^(?:\[\d[\d:.,/ T-]*\]\s*|[-*•#>]+\s+|\d+[.)]\s+|[A-Za-z_\"][\w\"]{0,40}:\s+)+")
CODE = re.compile(r"^[A-Za-z]{0,3}\d+[-_]?[A-Za-z]{0,3}$")
BRACKETS = (("(", ")"), ("[", "]"), ("（", "）"), ("「", "」"))
LISTED = re.compile(r"^(?:[-*•]|\d+[.)])\s")
LEVELS = (0, 4, 2, 1, -1)  # words of context; 0 is the whole unit so far, -1 no context at all
#: How a text was found, by level; then by default, and without any join.
WAYS = ("longer copies", "four words", "two words", "one word", "word anywhere")
UNCLOSED, OPEN = "no closing mark", "open structure"
JSON = re.compile(r'[{\[]\s*["{\[\]}]')


@lru_cache(maxsize=1 << 16)
def mask(token: str) -> str:
    """A word with its numbers blurred, so that wording alone is compared."""
    if not any(c.isdigit() for c in token):
        return token
    token = re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", token))
    return re.sub(r"[a-z]", "a", token) if CODE.match(token) else token


def units_of(text: str) -> list[dict]:
    """The text's units in order: words, whether a closing mark or an ellipsis ends it, the line's number, as written."""
    out = []
    for number, line in enumerate(text.split("\n")):
        line = line.strip()
        if not line:
            continue
        parts = [p for p in SENTENCE.split(line) if p and p.strip()]
        for k, part in enumerate(parts):
            part = part.strip()
            bare = MARKER.sub("", part) if k == 0 else part
            bare = bare or part
            dots = bare.endswith(("...", "…"))
            bare = (bare.rstrip(".… ") or bare) if dots else bare
            closed = not dots and bare.rstrip(CLOSERS)[-1:] in tuple(ENDS)
            words = [mask(w) for w in TOKEN.findall(bare)]
            stem = words[-1].rstrip(CLOSERS).rstrip(ENDS) if words else ""
            words = ([*words[:-1], stem] if stem else words[:-1]) if closed else words
            if words:
                out.append({"words": words, "closed": closed, "dots": dots, "line": number, "raw": part})
    return out


def style_of(units: list[dict]) -> str:
    """How a text marks its ends: "marked" if most units before the last bear closing marks, "bare" for one unit, else "lines"."""
    if len(units) < 2:
        return "marked" if units and units[0]["closed"] else "bare"
    closed = sum(u["closed"] for u in units[:-1])
    return "marked" if closed * 2 >= len(units) - 1 else "lines"


class _Hashes(dict):
    """64-bit hash of a word, made once for each word met."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()
#: Odd multipliers: of a word by its distance, and of a prefix by its length.
_BY_DISTANCE = [np.uint64(xxhash.xxh64_intdigest(f"distance {k}") | 1) for k in range(5)]
_BY_PLACE = xxhash.xxh64_intdigest("place") | 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 63-bit hash of 64-bit sums, every bit of which depends on all of theirs."""
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def places(units: list[list[str]], styles: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All words of the units in order, the unit of each, its position there, and by level but the last the hash of what precedes it.

    Level 0 is the whole unit so far, in any style; the others are so many words before, among texts of one style, -1 where
    there are fewer.
    """
    if len(_hashes) > 2_000_000:
        _hashes.clear()
    words = [w for unit in units for w in unit]
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    unit = np.repeat(np.arange(len(units)), sizes)
    start = np.cumsum(sizes) - sizes
    at = np.arange(len(words)) - start[unit]
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    keys = np.full((len(LEVELS) - 1, len(words)), -1, dtype=np.int64)
    if not len(words):
        return words, unit, at, keys
    # sum of the words so far, each times the place's multiplier: sums from the batch's start, less what lies before the unit
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(at.max()), _BY_PLACE, dtype=np.uint64)])
    before = np.r_[np.uint64(0), np.cumsum(h * power[at])[:-1]]
    keys[0] = _mix(before - before[start[unit]] + np.uint64(xxhash.xxh64_intdigest("whole")))
    style = np.fromiter((_hashes["\x1f" + s] for s in styles), np.uint64, len(styles))[unit]
    for row, level in enumerate(LEVELS[1:-1], 1):
        total = style * np.uint64(2 * level + 1)
        for k in range(1, level + 1):
            total[k:] += h[:-k] * _BY_DISTANCE[k]
        keys[row] = np.where(at >= level, _mix(total), -1)
    return words, unit, at, keys


#: What precedes the first word of every unit, and the one context of level -1: any text, any place.
START = int(places([["x"]], [""])[3][0, 0])
ANYWHERE = xxhash.xxh64_intdigest("anywhere") >> 1


def open_structure(text: str) -> bool:
    """A JSON text whose braces or quotes are not closed, or one that ends inside a character."""
    body = text.strip()
    if body.endswith("�"):
        return True
    if not JSON.match(body):
        return False
    depth, quoted, escaped = 0, False, False
    for c in body:
        if escaped:
            escaped = False
        elif quoted:
            escaped = c == "\\"
            quoted = c != '"'
        elif c == '"':
            quoted = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
    return quoted or depth > 0


def questions(text: str | None, units: list[dict] | None = None) -> tuple[bool | None, list[dict]]:
    """What decides about a text: True or False where it is plain, else None and the units to look up, the last one first.

    Each unit: words, style of the text, marked (its kind of sentence bears a closing mark here), dots, risky (ends like a
    decimal number cut at its point), alone (it is a whole line).
    """
    if not text or not text.strip():
        return False, []
    if open_structure(text):
        return True, []
    body = text.strip()
    if body[-1:] in "}]" and JSON.match(body):
        return False, []
    units = units_of(body) if units is None else units
    if not units:
        return False, []
    style, last, asked = style_of(units), units[-1], []
    for unit in units[-1:-3:-1]:
        # what stands before the last line is asked only where that line is a signature below unmarked text
        if unit is not last and (unit["closed"] or unit["line"] == last["line"] or (MARKER.match(unit["raw"]) and MARKER.match(last["raw"]))):
            break
        raw = unit["raw"]
        if not unit["closed"] and any(raw.count(o) > raw.count(c) for o, c in BRACKETS):
            return True, []
        risky = unit["closed"] and bool(re.search(r"\d\.$", raw))
        if unit["closed"] and not risky:
            break
        same = [u for u in units if u["line"] == unit["line"] and u is not unit]
        marked = not LISTED.match(raw) and (bool(same and same[-1]["closed"]) or (style == "marked" and len(units) > 1))
        asked.append({"words": unit["words"], "style": style, "marked": marked, "dots": unit["dots"], "risky": risky, "alone": not same})
    return (None, asked) if asked else (False, [])


def judge(levels: list[tuple[int, int, int]], marked: bool, dots: bool, risky: bool, alone: bool = False, spaced: bool = True) -> str:
    """"cut", "whole" or "tail" (whole and recurring as an end)."""
    return judge_by(levels, marked, dots, risky, alone, spaced)[0]


def judge_by(levels: list[tuple[int, int, int]], marked: bool, dots: bool, risky: bool, alone: bool = False, spaced: bool = True) -> tuple[str, str]:
    """(judge's answer, the way by which it was found).

    levels: for each of LEVELS, over all units elsewhere with the same prefix: how many ended with this last word, how
    many went on after it, how many have a longer word that begins with it. alone: the unit is the whole of its line;
    spaced: its script sets words apart.
    """
    weak = False
    for way, level, (ends, on, longer) in zip(WAYS, LEVELS, levels):
        if level < 0:
            # without context only half words tell, and words that all but never end anything
            if (ends + on) * 4 < longer or (spaced and on >= OFTEN and ends * OFTEN < on):
                return "cut", way
            continue
        if level == 0 and alone and ends and not on + longer:
            return "tail", way
        # part of a context, where most words may end a unit or not, takes more to tell; half words are plainer
        if ends + on + longer < (2 if level == 0 else 3 if marked or dots or not on else FIRM):
            continue
        if ends * 10 < on + longer:
            # a few longer copies alone leave open whether such wording may end here: the next level must agree
            if level == 0 and ends + on + longer < FIRM and not (marked or dots):
                weak = True
                continue
            return "cut", way
        if level == 0 and ends >= 2 and ends >= on + longer:
            return "tail", way
        if marked or dots:
            if ends * 2 < on + longer:
                return "cut", way
            continue
        if (longer > 0 and on == 0) or (level > 0 and ends + on + longer < FIRM):
            continue  # perhaps half a word that others broke off at as well, or too little to tell
        return "whole", way
    if weak:
        return "cut", WAYS[0]
    return ("cut" if (marked or dots) and not risky else "whole"), UNCLOSED


_ASKED = pa.list_(pa.struct([
    ("last", pa.string()), ("probes", pa.list_(pa.int64())), ("marked", pa.bool_()), ("dots", pa.bool_()), ("risky", pa.bool_()), ("alone", pa.bool_())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        verdicts, copies, styles, units, open_, asked = [], [], [], [], [], []
        for number, text in enumerate(batch.column(1).to_pylist()):
            text = text or ""
            mine = units_of(text.strip())
            verdict, questions_ = questions(text, mine)
            verdicts.append(verdict)
            copies.append(xxhash.xxh64_intdigest(text) >> 1)
            styles.append(style_of(mine))
            units.append([" ".join(u["words"]) for u in mine])
            asked.append([])
            open_ += [(number, q) for q in questions_]
        # the hashes of what precedes the last word, for all units in question at once
        lists = [q["words"] for _, q in open_]
        words, _, _, keys = places(lists, [q["style"] for _, q in open_])
        last = np.cumsum([len(x) for x in lists], dtype=np.int64) - 1
        for (number, q), at in zip(open_, last):
            asked[number].append({"last": words[at], "probes": [*keys[:, at].tolist(), ANYWHERE], "marked": q["marked"], "dots": q["dots"], "risky": q["risky"], "alone": q["alone"]})
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(verdicts, pa.bool_()), pa.array(copies, pa.int64()), pa.array(styles, pa.string()), pa.array(units, pa.list_(pa.string())), pa.array(asked, _ASKED)],
            names=["doc_id", "verdict", "copy_key", "style", "units", "asked"])


def place_filter(lookups: DataFrame) -> np.ndarray:
    """One bit for each place looked up, by the low bits of its hash: of fixed size, and right for any number of lookups, as an exact join follows."""
    low = F.col("at").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = lookups.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, cast(`at` & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(max(1, (1 << FILTER_BITS) >> 6), dtype=np.int64)
    for r in words:
        out[r["word"]] = r["bits"]
    return out


def _unfold(wanted: np.ndarray):
    """(what precedes, word) with how often the word ended and went on there, of distinct units; places that the filter rules out are left out."""
    low = np.int64((len(wanted) << 6) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = [u.split(" ") for u in batch.column(1).to_pylist()]
            words, unit, at, keys = places(units, batch.column(0).to_pylist())
            n = batch.column(2).to_numpy(zero_copy_only=False)[unit]
            final = np.r_[at[1:] == 0, True]
            code, names = pd.factorize(np.array(words, dtype=object))
            row = [keys.ravel(), np.full(len(words), ANYWHERE)]
            key, word = np.concatenate(row), np.tile(code, len(LEVELS))
            count, ends = np.tile(n, len(LEVELS)), np.tile(final, len(LEVELS))
            keep = key >= 0
            keep &= (wanted[(key & low) >> np.int64(6)] >> (key & np.int64(63))) & 1 == 1
            key, word, count, ends = key[keep], word[keep], count[keep], ends[keep]
            if not len(key):
                continue
            # summed inside the batch: what stands at the start of units, or anywhere, would be many rows of few kinds
            order = np.lexsort((word, key))
            key, word, count, ends = key[order], word[order], count[order], ends[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (word[1:] != word[:-1])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[first]), pa.array(names).cast(pa.string()).take(pa.array(word[first])), pa.array(np.add.reduceat(np.where(ends, count, 0), first)), pa.array(np.add.reduceat(np.where(ends, 0, count), first))],
                names=["at", "word", "ends", "on"])

    return run


def find_cut(documents: DataFrame) -> DataFrame:
    """doc_id, is_cut and why (null for whole texts) for every document.

    documents(doc_id long, text string); other columns are ignored. Null, empty and blank texts are not cut. Equal texts
    get equal results and do not vouch for each other; an id that occurs more often is cut if any text of it is. Texts are read whole, of any length.
    """
    schema = "doc_id long, verdict boolean, copy_key long, style string, units array<string>, asked array<struct<last:string,probes:array<long>,marked:boolean,dots:boolean,risky:boolean,alone:boolean>>"
    parsed = settle(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_parse, schema), "units")

    asked = parsed.where(F.size("asked") > 0).select("doc_id", "copy_key", "style", F.posexplode("asked").alias("k", "q"))
    asked = asked.select("doc_id", "copy_key", "style", "k", "q.*")
    probes = asked.select("doc_id", "k", "copy_key", "style", F.substring("last", 1, STEM).alias("stem"), "last", F.posexplode("probes").alias("level", "at")).where("`at` >= 0")
    lookups = settle(probes.select("at", "stem", "last").distinct(), "lookups")

    # every text speaks once, however many copies it has
    texts = parsed.groupBy("copy_key").agg(F.first("style").alias("style"), F.first("units").alias("units"))
    units = texts.select("style", F.explode("units").alias("unit")).groupBy("style", "unit").agg(F.count(F.lit(1)).alias("n"))
    shape = "at long, word string, ends long, on long"
    # summed by place and word: a place that many texts share, as the start of units, is spread by its words
    said = units.mapInArrow(_unfold(place_filter(lookups)), shape).groupBy("at", "word").agg(F.sum("ends").alias("ends"), F.sum("on").alias("on"))
    # every beginning of a word that follows, up to STEM letters: half words meet whole ones by an equi-join
    stems = said.select("at", "word", "ends", "on", F.explode(F.sequence(F.lit(1), F.least(F.length("word"), F.lit(STEM)))).alias("cut")).withColumn("stem", F.expr("substring(word, 1, cut)"))
    met = lookups.join(stems, ["at", "stem"]).where(F.col("word").startswith(F.col("last")))
    same = F.col("word") == F.col("last")
    counts = met.groupBy("at", "last").agg(
        F.sum(F.when(same, F.col("ends")).otherwise(0)).alias("ends"), F.sum(F.when(same, F.col("on")).otherwise(0)).alias("on"),
        F.sum(F.when(same, 0).otherwise(F.col("ends") + F.col("on"))).alias("longer"),
    )
    seen = probes.join(counts, ["at", "last"]).groupBy("doc_id", "k").agg(F.collect_list(F.struct("level", "ends", "on", "longer")).alias("found"))

    @F.pandas_udf("j string, way string")
    def decide(last: pd.Series, found: pd.Series, marked: pd.Series, dots: pd.Series, risky: pd.Series, alone: pd.Series) -> pd.DataFrame:
        out = []
        for word, rows, m, d, r, a in zip(last, found, marked, dots, risky, alone):
            levels = [(0, 0, 0)] * len(LEVELS)
            for row in rows if rows is not None else []:
                levels[row["level"]] = (max(0, row["ends"] - 1), row["on"], row["longer"])
            out.append(judge_by(levels, bool(m), bool(d), bool(r), bool(a), not HAN.match(word)))
        return pd.DataFrame(out, columns=["j", "way"])

    judged = asked.join(seen, ["doc_id", "k"], "left").select("doc_id", "k", decide("last", "found", "marked", "dots", "risky", "alone").alias("d")).select("doc_id", "k", "d.*")
    pick = lambda k: F.max(F.when(k, F.struct("j", "way")))
    first = judged.groupBy("doc_id").agg(pick((F.col("k") == 0) & (F.col("j") != "tail")).alias("last_j"), pick(F.col("k") == 1).alias("before_j"))
    answer = first.select("doc_id", F.coalesce("last_j", "before_j").alias("a"))
    asked_docs = answer.select("doc_id", F.coalesce(F.col("a.j") == "cut", F.lit(False)).alias("is_cut"), F.when(F.col("a.j") == "cut", F.col("a.way")).alias("why"))
    plain = parsed.where(F.size("asked") == 0).select("doc_id", F.coalesce("verdict", F.lit(False)).alias("is_cut"), F.when(F.col("verdict"), F.lit(OPEN)).alias("why"))
    return plain.unionByName(asked_docs).groupBy("doc_id").agg(F.max("is_cut").alias("is_cut"), F.max("why").alias("why"))
