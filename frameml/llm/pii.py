"""Personal data and secrets: regular expressions propose spans, checksums confirm them,
context words adjust their score.  DataFrame functions only.

A pattern's matches and the pieces between them give the positions: the start
of a match is the summed length of all that precedes it.  The patterns equal
the plain ones of the docstring of ``pii_columns``; look-behinds and possessive
repeats only keep them linear on long texts (a run that failed at its start is
not tried again at each of its characters).  Sums over all earlier matches are taken
in two steps, over whole blocks and inside one, so a text with n matches costs
n times the root of n small additions and no match carries the others along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.sources.tables import read_table

_LOCAL = "A-Za-z0-9._%+-"
# The proposing patterns, in the order of ties.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+)(?![A-Za-z0-9])",
}
BASE = ("email", "ip", "card", "phone")
# What a text must hold before a pattern is run over it.
HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), "phone": lambda t: t.rlike(r"\+[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    "secret": lambda t: t.rlike(r"[0-9a-f]{32}|AKIA|gh[pousr]_|sk-"),
}
# Context words within CONTEXT characters before a span and after the span of its kind
# before it, scores without and with one, and the score from which a span counts as likely.
CONTEXT, LIKELY = 40, 0.7
WORDS = {
    "email": "e-?mail|contact|mailto|write to|courriel|correo", "ip": "ip|address|host|server|client",
    "card": "card|visa|master|credit|debit|payment|tarjeta|carte|karte", "phone": "phone|tel|call|mobile|fax|handy",
    "iban": "iban|account|bank|konto|compte|cuenta", "secret": "token|key|secret|password|passwd|credential|auth",
}
SCORES = {"email": (0.9, 1.0), "ip": (0.5, 0.8), "card": (0.7, 1.0), "phone": (0.6, 0.9), "iban": (0.9, 1.0), "secret": (0.5, 0.95)}
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPANS = "array<struct<start:int,rank:int,stop:int,kind:string,value:string,score:double>>"
# Fixed value: code points of the blocks that a text is cut into before pieces are taken out of it.
BLOCK = 4096


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    def term(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda s, i: s + term(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, give 1 modulo 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 58, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(value, F.lit(" "), F.lit("")))
    return F.lit(True)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, merge, start: int) -> Column:
    """The merge (a sum or a maximum) of every number with all before it, as an array."""
    def whole(part: Column) -> Column:
        return F.aggregate(part, F.lit(start), lambda a, b: merge(a, b))

    def inner(s: Column) -> Column:
        x, step = s["x"], s["step"]
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / step).cast("int")),
                             lambda b: whole(F.slice(x, b * step + 1, step)))

        def at(t: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(x) - 1), lambda i: merge(
                F.get(t, F.floor(i / step).cast("int")), whole(F.slice(x, F.floor(i / step).cast("int") * step + 1, i % step + 1))))

        return _bound(blocks, lambda sums: _bound(F.transform(F.sequence(F.lit(0), F.size(sums) - 1),
                                                              lambda b: whole(F.slice(sums, F.lit(1), b))), at))

    step = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(numbers))).cast("int"))
    return _bound(F.struct(numbers.alias("x"), step.alias("step")), inner)


def _score(kind: str, near: Column) -> Column:
    low, high = SCORES[kind]
    return F.when(near.rlike(WORDS[kind]), high).otherwise(low)


def _proposed(kind: str, text: Column) -> Column:
    """All matches of a kind with their positions and scores, before any check."""
    pattern, rank = PATTERNS[kind], list(PATTERNS).index(kind)

    def placed(m: Column) -> Column:
        # Each match after the text since the match before it, which counts with it.
        steps = F.transform(m["value"], lambda v, i: F.length(F.get(m["piece"], i))
                            + F.coalesce(F.length(F.get(m["value"], i - 1)), F.lit(0)))
        starts = F.when(F.size(steps) > 0, _running(steps, lambda a, b: a + b, 0)).otherwise(F.array().cast("array<int>"))

        def span(v: Column, i: Column, at: Column) -> Column:
            begin = F.get(at, i)
            near = F.lower(F.right(F.get(m["piece"], i), F.lit(CONTEXT)))
            return F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + F.length(v)).alias("stop"),
                            F.lit(kind).alias("kind"), v.alias("value"), _score(kind, near).alias("score"))

        return _bound(starts, lambda at: F.transform(m["value"], lambda v, i: span(v, i, at)))

    return _bound(F.struct(F.split(text, pattern, -1).alias("piece"),
                           F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")), placed)


def pii_columns(df: DataFrame, text_col: str = "text", output: str = "pii") -> DataFrame:
    """Add ``output``, an array of (start, rank, stop, kind, value, score) by start and
    kind, positions in code points, end exclusive.

    Kinds: email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip, four
    dotted numbers of at most 255; card, 12 to 19 digits with single spaces or
    hyphens, Luhn; phone, ``+`` and 9 to 15 digits; iban, mod-97; secret, 32 or more
    hexadecimal digits or a key with a known prefix.  Matches are
    leftmost and do not overlap within a kind; one that fails its check is
    dropped and not retried.  A score rises with a context word in the CONTEXT characters
    before the span (as far as the match of its kind before it).  A null or empty text has an
    empty array, repeated rows and rows without id are read like others.  An
    existing column ``output`` is replaced; all others stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(_SPANS)
    raw = {k: F.when(HINTS[k](text), _proposed(k, text)).otherwise(none) for k in PATTERNS}

    def checked(kind: str) -> Column:
        return F.filter(raw[kind], lambda s: _confirmed(kind, s["value"]))

    return df.withColumn(output, F.array_sort(F.concat(*(checked(kind) for kind in PATTERNS))))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _between(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points start to stop of a text given in blocks."""
    a, b = (F.floor(x / BLOCK).cast("int") for x in (start, stop))
    first, last = F.coalesce(F.get(blocks, a), F.lit("")), F.coalesce(F.get(blocks, b), F.lit(""))
    apart = F.concat(F.substring(first, start % BLOCK + 1, F.lit(BLOCK)),
                     F.array_join(F.slice(blocks, a + 2, F.greatest(b - a - 1, F.lit(0))), ""),
                     F.substring(last, F.lit(1), stop % BLOCK))
    return F.when(stop <= start, "").when(a == b, F.substring(first, start % BLOCK + 1, stop - start)).otherwise(apart)


def redact(df: DataFrame, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """Replace every span of at least the score ``least`` by its kind in brackets;
    of spans that overlap, the later one replaces only what is left of it.  A null text stays
    null, an empty one empty; other columns, one named like a helper included, stay as they are."""
    name = "pii_spans"
    while name in df.columns:
        name += "_"
    text = F.col(text_col)
    found = F.filter(F.col(name), lambda s: s["score"] >= least)

    def whole(s: Column) -> Column:
        spans, blocks = s["spans"], s["blocks"]
        size = F.length(text)

        def joined(ends: Column) -> Column:
            def part(span: Column, i: Column) -> Column:
                done = F.coalesce(F.get(ends, i - 1), F.lit(0))
                label = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
                return F.when(span["stop"] > done, F.concat(_between(blocks, done, span["start"]), label)).otherwise("")

            return F.concat(F.array_join(F.transform(spans, part), ""),
                            _between(blocks, F.element_at(ends, -1), size))

        return _bound(_running(F.transform(spans, lambda x: x["stop"]), F.greatest, 0), joined)

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))
    out = _bound(F.struct(found.alias("spans"), cut.alias("blocks")), whole)
    marked = pii_columns(df, text_col, name)
    return marked.withColumn(text_col, F.when(F.size(found) > 0, out).otherwise(text)).drop(name)


def pii_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the spans of every row, the spans themselves, their scores in percent in
    the same order, and how many spans are likely (score of LIKELY or more)."""
    found = pii_columns(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    base = F.filter("pii", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"),
                        F.array_join(F.transform("pii", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores"),
                        F.size(F.filter("pii", lambda s: s["score"] >= LIKELY)).cast("long").alias("n_likely"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(read_table(spark, sf_dir, "documents"))


def _sql_spans(kind: str, pattern: str, check: str) -> str:
    low, high = (round(100 * x) for x in SCORES[kind])
    return f"""{kind} as (
  select doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
      'start': (list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::bigint,
      'rank': {list(PATTERNS).index(kind)}, 'kind': '{kind}', 'v': m[i],
      'score': case when regexp_matches(lower(right(p[i], {CONTEXT})), '{WORDS[kind]}') then {high} else {low} end}}), lambda s: {check}) as spans
  from (select doc_id, regexp_extract_all(text, '{pattern}') as m, regexp_split_to_array(text, '{pattern}') as p from d)
)"""


_DIGITS = "regexp_replace(s.v, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(0, length({_DIGITS})), lambda i: case when i % 2 = 0 then {_DIGITS}[length({_DIGITS}) - i]::int"
         f" else [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][{_DIGITS}[length({_DIGITS}) - i]::int + 1] end)) % 10 = 0")
_BARE = "replace(s.v, ' ', '')"
_MOD97 = (f"list_reduce(list_transform(string_split(substr({_BARE}, 5) || substr({_BARE}, 1, 4), ''), lambda c: "
          "case when ascii(c) < 58 then ascii(c) - 48 else ascii(c) - 55 end), "
          "lambda a, b: (a * case when b < 10 then 10 else 100 end + b) % 97) = 1")
_COUNT = "len(list_filter(f, lambda s: s.kind = '{0}'))::bigint as n_{0}"
_LIST = "array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || (s.start + length(s.v))), ',')"
ORACLE = ("with d as (select doc_id, coalesce(text, '') as text from documents),\n" + ",\n".join((
    _sql_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    _sql_spans("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
               "list_max(list_transform(string_split(s.v, '.'), lambda x: x::hugeint)) <= 255"),
    _sql_spans("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) between 12 and 19 and {_LUHN}"),
    _sql_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15"),
    _sql_spans("iban", r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?", _MOD97),
    _sql_spans("secret", r"\b([0-9a-f]{32,}|AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,})\b", "true"))) + f""",
a as (select doc_id, list_sort(list_concat(list_concat(list_concat(email.spans, ip.spans), list_concat(card.spans, phone.spans)),
             list_concat(iban.spans, secret.spans))) as f
      from email join ip using (doc_id) join card using (doc_id) join phone using (doc_id) join iban using (doc_id)
      join secret using (doc_id))
select doc_id, {', '.join(_COUNT.format(k) for k in BASE)},
       sha256({_LIST.format("list_filter(f, lambda s: s.rank < 4)")}) as base_sha256, {_LIST.format("f")} as spans,
       coalesce(array_to_string(list_transform(f, lambda s: s.score::varchar), ','), '') as scores,
       len(list_filter(f, lambda s: s.score >= {round(100 * LIKELY)}))::bigint as n_likely from a
""")

QUERIES = {"op9_pii": op9_pii}
SQL = {"op9_pii": ORACLE}
