r"""Personal data: base patterns, then bootstrapped contextual extraction.

Base entities are leftmost and non-overlapping per kind; a match that fails its check (ip parts, card digits and Luhn, phone digits)
is dropped and not retried:
  email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+    ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
  card [0-9]([\x20-]?[0-9])+, 14 to 19 digits, Luhn           phone \+[0-9][\x20().0-9-]+[0-9], 10 to 15 digits

Bootstrapping: the seeds are the base entities, keys of a few public formats, and values behind a label that names a secret; the latter two
are spans of kind 'id' themselves. Every seed and every other word that looks like an identifier (at least MIN_CODE characters with a digit and
a letter, or MIN_CODE digits) is an instance, its value. The lexical patterns of an instance are the word before it, the two words before it, the word
after it, its label (letters before a ':', '=' or '#' that begins its value, or the word before such a sign), and its form (signs it is made of, length, and
the four letters it begins with, if it does). The graph of (pattern, value) pairs is counted over all documents. In each round a pattern's
confidence is the mean confidence of its values, with PRIOR doubtful values added, and a value that is no seed has 1 - the product of
(1 - confidence) over its patterns of at least SUPPORT values. After ROUNDS rounds the places in a pattern of at least ACCEPT are new spans, kind
'id' (their values then have as much). A pattern or a value may be as common as it likes: pairs are counted before the shuffle, and a round joins
counts, never texts. Patterns and values are compared by 128-bit digests.

Positions are code points, ends exclusive. Null and empty texts have no entities; null ids and repeated rows are kept as rows of
their own; any length of text is read whole.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import blocks, cut, fresh, remove, table, with_columns

KINDS = ("email", "ip", "card", "phone", "id")
MIN_CODE = 6
SUPPORT, PRIOR, ROUNDS, ACCEPT = 5, 3.0, 3, 0.8
#: Accepted patterns that are sent to every task at most (about 50 bytes each).
PATTERNS = 200_000
#: Labels that name a secret, and public formats of keys.
SECRETS = frozenset("password passwd pwd secret token api_key apikey access_key secret_key auth_token".split())
_KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never ends inside of a run of digits, so that a run is tried at its first digit only.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# From a word's first character only, so that a long word without digits is read once.
_CODE = re.compile(r"(?<![^ \t-\r])[^ \t-\r0-9]*[0-9][^ \t-\r]*")
_LABEL = re.compile(r"([A-Za-z_]+)[:=#](?=.)")
_TRIM = "\"'()[]{}<>.,;!?*|"
_DROP_NON_DIGITS = {c: None for c in map(ord, " ().-+")}


def emails(text: str):
    """An '@' is in no local part, so that a match begins where the run of local characters before its '@' begins."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        else:
            done = at + 1  # no later match begins before this '@'
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order of start and kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().translate(_DROP_NON_DIGITS)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(m.group().translate(_DROP_NON_DIGITS)) <= 15:
                    found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_WORD = re.compile(r"[^ \t-\r]+")
_SIGNS = ("=", ":", ":=", "=>", "#")


def _form(value: str) -> list[str]:
    """The patterns of a value's form."""
    kinds = [("h", "0123456789abcdef"), ("H", "0123456789ABCDEF"), ("U", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("L", "0123456789abcdefghijklmnopqrstuvwxyz")]
    kind = next((k for k, signs in kinds if not value.strip(signs)), "")
    if not kind or value.isdigit():
        return []
    head = value[:4] if value[:4].isalpha() else ""
    return [f"~{kind}{len(value)}"] + ([f"~{kind}{len(value)}{head}"] if head else [])


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool, bool, str, list[str]]]:
    """(start, end, seed, own, value, patterns) of seeds and of words that look like identifiers and overlap no base entity. own: a seed that is no base entity."""
    if not base and not _DIGIT.search(text):
        return []
    found, taken, words, starts = [], [], [], []

    def around(start: int, end: int):
        """The one or two words before a place, the sign between, and the word after, in lower case without outer punctuation."""
        if not words:
            words.extend(m.span() for m in _WORD.finditer(text))
            starts.extend(w[0] for w in words)
        k = bisect.bisect_right(starts, start) - 1
        inside, sign, before = text[words[k][0]:start].strip(_TRIM).lower(), "", []
        if inside:
            before.append(inside)
        k -= 1
        while k >= 0 and len(before) < 2:
            word = text[slice(*words[k])]
            core = word.strip(_TRIM).lower()
            if word in _SIGNS and not before:
                sign = word
            elif core:
                before.append(core)
            else:
                break
            k -= 1
        j = bisect.bisect_left(starts, end)
        return before, sign, text[slice(*words[j])].strip(_TRIM).lower() if j < len(words) else ""

    def patterns(before, after, label):
        pats = [f"<{before[0]}"] if before else []
        pats += [f"<<{before[1]} {before[0]}"] if len(before) > 1 else []
        return pats + ([f">{after}"] if after else []) + ([f"={label}"] if label else [])

    for a, _, b in base:
        before, _, after = around(a, b)
        found.append((a, b, True, False, text[a:b], patterns(before, after, "")))
        taken.append((a, b))
    taken.sort()
    k, reach = 0, -1
    for m in _CODE.finditer(text):
        a, word = m.start(), m.group()
        core = word.strip(_TRIM)
        if len(core) < MIN_CODE:
            continue
        a += word.index(core)
        b = a + len(core)
        while k < len(taken) and taken[k][0] < b:
            reach, k = max(reach, taken[k][1]), k + 1
        if reach > a:
            continue
        labelled = _LABEL.match(core)
        value = core[labelled.end():].strip(_TRIM) if labelled else core
        digits = sum(c in "0123456789" for c in value)
        if len(value) < MIN_CODE or not digits or (digits < len(value) and not any(c.isalpha() for c in value)):
            continue
        before, sign, after = around(a, b)
        label = labelled.group(1).lower() if labelled else before[0] if sign and before else ""
        own = bool(_KEY.fullmatch(value)) or label in SECRETS
        at = a + core.index(value, labelled.end() if labelled else 0)
        found.append((at, at + len(value), own, own, value, patterns(before, after, label) + _form(value)))
    return found


_INSTANCE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("own", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_ID = KINDS.index("id")


def _listed(found) -> pa.Array:
    return pa.array([[dict(zip(("start", "end", "seed", "own", "value", "patterns"), s, strict=True)) for s in i] for i in found], pa.list_(_INSTANCE))


def _first_pass(batches):
    for whole in batches:
        for part in blocks(whole, 1):
            texts = [t or "" for t in part.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            found = [instances(t, b) for t, b in zip(texts, base, strict=True)]
            every = [sorted([*b, *((i[0], _ID, i[1]) for i in f if i[3])]) for b, f in zip(base, found, strict=True)]
            spans = [[dict(zip(("start", "kind", "end"), s, strict=True)) for s in b] for b in every]
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(4)]
            digest = pa.array([hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base])
            yield pa.RecordBatch.from_arrays([part.column(0), *counts, digest, pa.array(spans, _SPANS), _listed(found)], names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "instances"])


def _only_instances(batches):
    for whole in batches:
        for part in blocks(whole, 0):
            found = [f for f in (instances(t, base_spans(t)) for t in part.column(0).to_pylist() if t) if f]
            yield pa.RecordBatch.from_arrays([_listed(found)], names=["instances"])


_ARRAY = "array<struct<start:long,end:long,seed:boolean,own:boolean,value:string,patterns:array<string>>>"


def _digest(c):
    return F.unhex(F.md5(F.col(c).cast("binary")))


def score_graph(places: DataFrame) -> DataFrame:
    """places: seed, value, pattern. Returns the digests of the patterns that reach ACCEPT, in column pattern.

    The pairs are materialised once; each round shuffles counts of distinct pairs.
    """
    used: list[str] = []
    pairs = cut(places.groupBy(_digest("value").alias("value"), _digest("pattern").alias("pattern")).agg(F.max("seed").alias("seed")), used)
    seeds = pairs.groupBy("value").agg(F.max("seed").alias("seed"))
    values = cut(seeds.select("value", "seed", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("confidence")), used)
    for n in range(ROUNDS):
        patterns = pairs.select("pattern", "value").join(values, "value").groupBy("pattern").agg(F.count("*").alias("support"), (F.sum("confidence") / (F.count("*") + PRIOR)).alias("trust"))
        good = patterns.filter((F.col("support") >= SUPPORT) & (F.col("trust") > 0))
        if n == ROUNDS - 1:
            break
        # Logarithms of doubt are added in whole units, so that the order of the rows doesn't matter.
        doubt = F.round(F.log1p(-F.least("trust", F.lit(0.999999))) * 1e9).cast("long")
        lifted = pairs.select("pattern", "value").join(good, "pattern").groupBy("value").agg((1 - F.exp(F.sum(doubt) / 1e9)).alias("lift"))
        values = cut(values.select("value", "seed").join(lifted, "value", "left").select("value", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("lift", F.lit(0.0))).alias("confidence")), used)
    sure = cut(good.filter(F.col("trust") >= ACCEPT).select("pattern"))
    remove(places.sparkSession, used)
    return sure


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id_col, counts of the base kinds, base_sha256, spans (text) and span_list (start, kind, end)."""
    first = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = first.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start:long,kind:int,end:long>>, instances {_ARRAY}"
    rows = cut(first.mapInArrow(_first_pass, schema).withColumn("row", F.monotonically_increasing_id()))
    places = rows.select("row", F.explode("instances").alias("i")).select("row", "i.start", "i.end", "i.seed", "i.value", F.explode("i.patterns").alias("pattern"))
    sure = score_graph(places.select("seed", "value", "pattern"))
    new = places.filter("NOT seed").select("row", "start", "end", _digest("pattern").alias("pattern")).join(sure, "pattern")
    per_row = new.groupBy("row").agg(F.collect_set(F.struct("start", F.lit(_ID).alias("kind"), "end")).alias("more"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:long,kind:int,end:long>>"))))
    name = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform("span_list", lambda s: F.concat_ws(":", F.get(name, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")
    out = rows.drop("instances").join(per_row, "row", "left").withColumn("span_list", spans).withColumn("spans", text)
    return out.select(F.col("id").alias(id_col), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "span_list")


def _hidden(text: str | None, marks) -> str | None:
    """The text with spans (start, kind, end) replaced by their kinds; overlapping spans become one, of the first kind."""
    out, done = [], 0
    for start, kind, end in marks:
        if text is None or end <= done:
            continue
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = end
    return text if text is None else "".join(out) + text[done:]


def hide(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with all personal data replaced by its kind in angle brackets; row by row, whatever the ids.

    The first pass gives the instances of the graph, the second finds them again and looks their patterns up. No text is shuffled as long as at most
    PATTERNS patterns are accepted; beyond that, spans are joined to the texts by row.
    """
    places = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_only_instances, f"instances {_ARRAY}")
    places = places.select(F.explode("instances").alias("i")).select("i.seed", "i.value", F.explode("i.patterns").alias("pattern"))
    sure = score_graph(places)
    if sure.count() > PATTERNS:
        row = fresh("row", docs.columns)
        rows = cut(docs.withColumn(row, F.monotonically_increasing_id()))
        return redact(rows, find_pii(rows, row, text_col), row, text_col).select(*docs.columns)
    known = {bytes(r[0]) for r in sure.toLocalIterator()}
    names = docs.columns

    def marks(text):
        base = base_spans(text)
        return sorted([*base, *((i[0], _ID, i[1]) for i in instances(text, base) if i[3] or not i[2] and any(hashlib.md5(p.encode()).digest() in known for p in i[5]))])

    def run(batches):
        for whole in batches:
            for part in blocks(whole, text_col):
                texts = [t if t is None else _hidden(t, marks(t)) for t in part.column(names.index(text_col)).to_pylist()]
                yield with_columns(part, {text_col: pa.array(texts, pa.string())})

    return docs.mapInArrow(run, docs.schema)


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every found span replaced by its kind in angle brackets; overlapping spans become one, of the first kind.

    found has span_list per id; the columns stay those of docs. An id with several texts must not occur.
    """
    names = docs.columns
    key, marks = fresh("id", names), fresh("span_list", names)
    spans = found.select(F.col(id_col).alias(key), F.col("span_list").alias(marks)).filter((F.size(marks) > 0) & F.col(key).isNotNull()).dropDuplicates([key])

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(names.index(text_col)).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)
            texts = [_hidden(text, [(s["start"], s["kind"], s["end"]) for s in found or ()]) for text, found in rows]
            arrays = list(batch.columns[:len(names)])
            arrays[names.index(text_col)] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    joined = docs.join(spans, docs[id_col] == F.col(key), "left").select(*(docs[c] for c in names), marks)
    return joined.mapInArrow(run, docs.schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents")).drop("span_list")
