"""Secret scans: fixed patterns plus sliding-window entropy, all as column expressions.

Fixed patterns: assignments (``password = ...``), access keys and long hex
strings.  The entropy part takes candidate strings (runs of one character
class), slides a window over each and keeps the sum of ``c * log2(c)`` over
its character counts up to date: a step changes the count of the character
that leaves and of the one that enters, nothing else.  The counts themselves
aren't kept: these two are counted anew within the window.  A candidate with a
window above the threshold of its class is a span, unless the allow list knows
it or a span of the fixed patterns covers it.

Spark has no function for match positions.  Matches are put between marker
characters and the text is split there; positions are running sums of the part
lengths.  A marker character in the text is first replaced by another control
character, which is as foreign to all patterns.

Edge cases: a NULL or empty text has no span; repeated rows give repeated
results; texts of any length are scanned whole, in time linear in their length
apart from a 256th of the square of the number of matches.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftscore.llm.common import documents, set_apart

MARK, GROUP, FOREIGN = "\x01", "\x02", "\x03"

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Every assignment holds one of these, in either case.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

#: Entropy window in characters, and bits a character from which a window is a secret's.
WINDOW = 20
#: kind: (candidate strings, other patterns that a candidate must hold, bits)
CLASSES = {
    "entropy_hex": (r"[0-9A-Fa-f]{20,}", (r"[0-9]", r"[A-Fa-f]"), 3.0),
    "entropy_base64": (r"[A-Za-z0-9+/=_-]{20,}", (r"[0-9]", r"[a-z]", r"[A-Z]"), 3.7),
}
#: Candidates that are no secrets: placeholders, alphabets, identifiers, addresses.
ALLOW = (r"(?i)example|sample|placeholder|changeme|dummy|your[_-]|xxxx|0123456789|123456789|abcdefgh"
         r"|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^sha(1|256|384|512)-|^//")

#: In redaction the allow list hides no more than it knows: whole runs, the piece between separators that holds a
#: placeholder, and the short pieces of an address.
ALLOW_WHOLE = (r"^(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$|^(?i:sha(1|256|384|512))-[A-Za-z0-9+/]+=*$")
PLACEHOLDER = (r"(?i)[^/=_-]*(?:example|sample|placeholder|changeme|dummy|your(?=[_-])|xxxx|0123456789|123456789|abcdefgh)[^/=_-]*")

KINDS = ("assign", "access", "hex", *CLASSES)
SPAN = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, not at each place and step where ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def part_starts(lengths: Column) -> Column:
    """Running sums of an array, each without its own element; chunked, so a long array isn't copied per element."""
    return bound(lengths, _part_starts)


def _part_starts(lengths: Column) -> Column:
    size = 256
    chunks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(lengths) / size).cast("int") - 1, F.lit(0)))

    def chunk(k: Column) -> Column:
        return F.slice(lengths, k * size + 1, size)

    def scan(values: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, zero, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    sums = F.transform(chunks, lambda k: F.aggregate(chunk(k), F.lit(0).cast("bigint"), lambda s, x: s + x))
    return F.flatten(F.zip_with(chunks, scan(sums, F.lit(0).cast("bigint")), lambda k, at: scan(chunk(k), at)))


def add_matches(df: DataFrame, text: str, when: Column, pattern: str, group: int | None, name: str) -> DataFrame:
    """Add ``name``: array of (start, value, own) of all matches; own is the group's text (the match, if none)."""
    mark = f"{MARK}$0{GROUP}${group or 0}{MARK}"
    df = df.withColumn("_parts", F.when(when, F.split(F.regexp_replace(F.col(text), pattern, mark), MARK)))
    df = df.withColumn("_values", F.transform("_parts", lambda p: F.substring_index(p, GROUP, 1)))
    starts = part_starts(F.transform("_values", lambda p: F.length(p).cast("bigint")))

    def matches(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(2), F.size(all_["parts"]) - 1, F.lit(2)), lambda i: F.struct(
            F.element_at(all_["starts"], i).alias("start"), F.element_at(all_["values"], i).alias("value"),
            F.substring_index(F.element_at(all_["parts"], i), GROUP, -1).alias("own")))

    found = bound(F.struct(starts.alias("starts"), F.col("_values").alias("values"), F.col("_parts").alias("parts")), matches)
    none = F.array().cast("array<struct<start:bigint,value:string,own:string>>")
    return df.withColumn(name, F.when(F.size("_parts") > 1, found).otherwise(none)).drop("_parts", "_values")


def entropy_at_least(value: Column, bits: float, window: int = WINDOW) -> Column:
    """True if some window of ``value`` has a Shannon entropy of ``bits`` or more a character."""
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    most = window * (math.log2(window) - bits) + 1e-9  # H >= bits just if the sum is no more than this

    def weight(c: Column) -> Column:
        return F.element_at(table, c + 1)

    def step(chars: Column, s: Column, j: Column) -> Column:
        # The window before this step ends at j - 1 and has at most `window` characters.
        full = j > window
        before = F.slice(chars, F.greatest(j - window, F.lit(1)), F.least(j - 1, F.lit(window)))
        leaving, entering = F.element_at(chars, F.greatest(j - window, F.lit(1))), F.element_at(chars, j)
        n_out = F.size(F.filter(before, lambda c: c == leaving))
        n_in = F.size(F.filter(before, lambda c: c == entering)) - F.when(full & (leaving == entering), 1).otherwise(0)
        total = (s["total"] - F.when(full, weight(n_out) - weight(n_out - 1)).otherwise(0.0)
                 + weight(n_in + 1) - weight(n_in))
        return F.struct(total.alias("total"), F.when(j >= window, F.least(s["least"], total)).otherwise(s["least"]).alias("least"))

    zero = F.struct(F.lit(0.0).alias("total"), F.lit(float("inf")).alias("least"))
    return bound(F.split(value, ""), lambda chars: F.aggregate(
        F.sequence(F.lit(1), F.size(chars)), zero, lambda s, j: step(chars, s, j), lambda s: s["least"])) <= most


def is_secret(holds: tuple[str, ...], bits: float, inside: bool = False) -> Callable[[Column], Column]:
    """The test of a candidate of one class; cheap parts first.  ``inside``: also of what the allow list hides."""
    def stretch(value: Column) -> Column:
        ok = F.length(value) >= WINDOW
        for h in holds:
            ok = ok & value.rlike(h)
        return F.when(ok, entropy_at_least(value, bits)).otherwise(False)

    def hidden(value: Column) -> Column:
        rest = F.when(value.startswith("//"), F.split(value, f"{PLACEHOLDER}|[/=_-]")).otherwise(F.split(value, PLACEHOLDER))
        return F.when(value.rlike(ALLOW) & ~value.rlike(ALLOW_WHOLE), F.exists(rest, stretch)).otherwise(False)

    def test(m: Column) -> Column:
        end = m["start"] + F.length(m["value"])
        bare = ~F.exists("_base", lambda b: (b["start"] <= m["start"]) & (end <= b["end"]))
        ok = bare & ~m["value"].rlike(ALLOW)
        for h in holds:
            ok = ok & m["value"].rlike(h)
        found = F.when(ok, entropy_at_least(m["value"], bits))
        return (found.when(bare, hidden(m["value"])) if inside else found).otherwise(False)

    return test


def add_spans(docs: DataFrame, text: str = "text", spans: str = "spans", inside: bool = False) -> DataFrame:
    """Add ``spans`` (in place of a column of that name): array of (start, ord, end, kind), by start, then kind as listed; code points, end exclusive.

    ``ord`` is the place of ``kind`` in ``KINDS``; the first three are the fixed patterns.
    With ``inside``, a secret that is joined to something that the allow list knows is a span too.
    """
    named = set_apart(docs, (text,))
    raw = F.coalesce(F.col(text), F.lit(""))
    df = named.withColumn("_text", F.replace(F.replace(raw, F.lit(MARK), F.lit(FOREIGN)), F.lit(GROUP), F.lit(FOREIGN)))
    low = F.lower(F.col("_text"))
    has_word = F.lit(False)
    for w in ASSIGN_WORDS:
        has_word = has_word | low.contains(w)

    def as_spans(matches: Column, kind: str) -> Column:
        return F.transform(matches, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("ord"),
            (m["start"] + F.length(m["value"])).alias("end"), F.lit(kind).alias("kind")))

    df = add_matches(df, "_text", has_word, ASSIGN, 2, "_assign")
    df = add_matches(df, "_text", F.col("_text").contains("AKIA"), ACCESS, None, "_access")
    df = add_matches(df, "_text", F.col("_text").rlike(HEX), HEX, None, "_hex")
    df = df.withColumn("_base", F.concat(
        as_spans(F.filter("_assign", lambda m: F.length(m["own"]) >= 8), "assign"),
        as_spans(F.filter("_access", lambda m: F.length(m["value"]) >= 16), "access"),
        as_spans(F.col("_hex"), "hex")).cast(SPAN))
    for kind, (pattern, holds, bits) in CLASSES.items():
        df = add_matches(df, "_text", F.col("_text").rlike(pattern), pattern, None, f"_{kind}")
        df = df.withColumn(f"_{kind}", as_spans(F.filter(f"_{kind}", is_secret(holds, bits, inside)), kind).cast(SPAN))
    found = F.concat("_base", *[F.col(f"_{k}") for k in CLASSES])
    df = df.withColumn(spans, F.when(F.size(found) > 0, F.array_sort(found)).otherwise(F.array().cast(SPAN)))
    kept = [c for c in docs.columns if c != spans]
    place = dict(zip(docs.columns, named.columns))
    return df.select(*[F.col(place[c]).alias(c) for c in kept], spans)


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask``, spans that overlap as one; ``n_chars`` follows the text."""
    named = set_apart(docs, ("text", "n_chars"))
    columns = named.columns
    df = add_spans(named, spans="_spans", inside=True)
    # Left to right; `at` is the first code point not yet passed on.
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(F.col("text"), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        piece = F.when(x["start"] >= s["at"], F.array(gap, F.lit(mask))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], piece).alias("out"))

    clean = F.aggregate("_spans", zero, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    df = df.withColumn("text", F.when(F.size("_spans") > 0, clean).otherwise(F.col("text")))
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return df.select(*columns).toDF(*docs.columns)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents``."""
    df = add_spans(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["ord"] < 3)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return df.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle() -> str:
    """DuckDB SQL: places as lengths of what stands before, entropy of every window from its own counts."""
    def matches(name: str, pattern: str, group: int) -> str:
        return f"""
{name} AS (
  SELECT rid, start, start + length(value) AS stop, value, own FROM (
    SELECT rid, i, split_part(part, chr(2), 1) AS value, split_part(part, chr(2), 2) AS own,
           coalesce(sum(length(split_part(part, chr(2), 1))) OVER (
             PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM (SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
      SELECT rid, string_split(regexp_replace(text, {_sql_text(pattern)}, chr(1) || '\\0' || chr(2) || '\\{group}' || chr(1), 'g'), chr(1)) AS parts
      FROM docs))) WHERE i % 2 = 0)"""

    found = [matches("assigns", ASSIGN, 2), matches("accesses", ACCESS, 0), matches("hexes", HEX, 0)]
    base = """
base AS (
  SELECT rid, start, 0 AS ord, stop, 'assign' AS kind FROM assigns WHERE length(own) >= 8
  UNION ALL SELECT rid, start, 1, stop, 'access' FROM accesses WHERE length(value) >= 16
  UNION ALL SELECT rid, start, 2, stop, 'hex' FROM hexes)"""
    more, unions = [], []
    for k, (kind, (pattern, holds, bits)) in enumerate(CLASSES.items()):
        tests = " AND ".join(f"regexp_matches(value, {_sql_text(h)})" for h in holds)
        more.append(matches(f"runs_{k}", pattern, 0))
        more.append(f"""
windows_{k} AS (
  SELECT rid, start, stop, string_split(value[w:w + {WINDOW - 1}], '') AS chars FROM (
    SELECT rid, start, stop, value, unnest(generate_series(1, length(value) - {WINDOW - 1})) AS w FROM runs_{k} r
    WHERE {tests} AND NOT regexp_matches(value, {_sql_text(ALLOW)})
      AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND b.start <= r.start AND r.stop <= b.stop)))""")
        unions.append(f"""
  UNION ALL SELECT DISTINCT rid, start, {3 + k}, stop, '{kind}' FROM windows_{k}
  WHERE list_sum(list_transform(chars, lambda c: -log2(len(list_filter(chars, lambda x: x = c)) / {WINDOW}.0) / {WINDOW})) >= {bits} - 1e-9""")
    steps = ",".join([*found, base, *more])
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, replace(replace(coalesce(text, ''), chr(1), chr(3)), chr(2), chr(3)) AS text FROM documents),{steps},
spans AS (
  SELECT * FROM base{''.join(unions)}),
listed AS (
  SELECT rid, countif(kind = 'assign')::BIGINT AS n_assign, countif(kind = 'access')::BIGINT AS n_access, countif(kind = 'hex')::BIGINT AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE ord < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (rid)
"""


ORACLE = oracle()
