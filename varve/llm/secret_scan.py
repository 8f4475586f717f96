"""Secret scans: fixed patterns, and parts of tokens that two character Markov models tell from ordinary identifiers.

Everything is built-in column expressions. A text is looked at row by row; only the training counts are shuffled, and
the model that comes to the driver has one number per pair of characters of a fixed alphabet.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds and patterns that results must agree with. A run of [0-9a-f] or after AKIA is matched
# greedily, so asking for its least length in the pattern finds the same spans as dropping short matches afterwards.
WORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in WORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "(AKIA[A-Z0-9]{12,})"
HEX = "([0-9a-f]{32,})"
KINDS = (("assign", ASSIGN, 2), ("access", ACCESS, 1), ("hex", HEX, 1))
LEAST_SECRET = 8

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
COMMON_FIRST = "enirtasdhulcgmobpfvwkzyxqj0123456789"  # only the order in which patterns try characters
UNIFORM = (0.1, 0.5)  # share of a uniform choice of the next character in the ordinary and in the random model
THRESHOLD = 12.0  # natural log of the likelihood ratio of a token or a part of one
MASK = "[SECRET]"


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, step=lambda a, b: a + b) -> Column:
    """What ``step`` makes of each value and all before it, for an array of integers: sums, or with ``greatest`` maxima.

    The array is walked in blocks of about the square root of its size, and the blocks' last values once more, so that a
    text of very many matches is not copied at each of them.
    """
    none = F.expr("cast(array() as array<int>)")

    def plain(a: Column) -> Column:
        begin = F.struct(F.lit(None).cast("int").alias("at"), none.alias("out"))

        def one(s: Column, x: Column) -> Column:
            now = F.coalesce(step(s["at"], x), x)
            return F.struct(now.alias("at"), F.concat(s["out"], F.array(now)).alias("out"))

        return F.aggregate(a, begin, one, lambda s: s["out"])

    def blocks(a: Column) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(a))).cast("int"))
        last = F.floor((F.size(a) - 1) / size).cast("int")
        return _let(size, lambda n: F.transform(F.sequence(F.lit(0), last), lambda k: plain(F.slice(a, k * n + 1, n))))

    def joined(inner: Column) -> Column:
        before = F.concat(F.array(F.lit(None).cast("int")), plain(F.transform(inner, lambda x: F.element_at(x, -1))))
        return F.flatten(F.zip_with(inner, F.slice(before, 1, F.size(inner)), lambda a, o: F.transform(a, lambda x: F.coalesce(step(o, x), x))))

    return _let(values, lambda a: F.when(F.size(a) > 0, _let(blocks(a), joined)).otherwise(none))


SPAN = "array<struct<start:int,end:int,secret:string,from:int,to:int>>"


def located(text: Column, pattern: str, group: int) -> Column:
    """``array<struct<start, end, secret, from, to>>`` of the leftmost non-overlapping matches, from 0.

    The text between matches gives the places, as running sums of lengths: ``start`` and ``end`` in code points, ``from``
    and ``to`` in bytes of UTF-8.
    """
    p = F.lit(pattern)
    none = F.expr(f"cast(array() as {SPAN})")

    def parts(hits: Column, secrets: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.struct(hits.alias("hits"), secrets.alias("secrets"), F.slice(gaps, 1, F.size(hits)).alias("gaps"))

    def walk(x: Column) -> Column:
        def ends(length) -> Column:
            return running(F.zip_with(x["gaps"], x["hits"], lambda g, h: length(g) + length(h)))

        def spans(to: Column) -> Column:
            def at(i: Column) -> Column:
                hit = x["hits"][i]
                end, stop = to["chars"][i], to["bytes"][i]
                return F.struct((end - F.length(hit)).alias("start"), end.alias("end"), x["secrets"][i].alias("secret"), (stop - F.octet_length(hit)).alias("from"), stop.alias("to"))

            return F.transform(F.sequence(F.lit(0), F.size(x["hits"]) - 1), at)

        return _let(F.struct(ends(F.length).alias("chars"), ends(F.octet_length).alias("bytes")), spans)

    def some(x: Column) -> Column:
        return F.when(F.size(x["hits"]) > 0, walk(x)).otherwise(none)

    if group == 0:  # matches are looked for once
        return _let(F.regexp_extract_all(text, p, F.lit(0)), lambda hits: F.when(F.size(hits) > 0, _let(parts(hits, hits), some)).otherwise(none))
    found = parts(F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group)))
    return F.when(text.rlike(pattern), _let(found, some)).otherwise(none)


def span(start: Column, rank: int, end: Column, kind: str, secret: Column, from_: Column, to: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), secret.alias("secret"), from_.alias("from"), to.alias("to"))


def base_spans(text: Column) -> Column:
    """``array<struct<start, rank, end, kind, secret, from, to>>`` of the fixed patterns, by start and then by kind."""

    def of(rank: int, kind: str, pattern: str, group: int) -> Column:
        found = located(text, pattern, group)
        if kind == "assign":
            found = F.filter(found, lambda s: F.length(s["secret"]) >= LEAST_SECRET)
        return F.transform(found, lambda s: span(s["start"], rank, s["end"], kind, s["secret"], s["from"], s["to"]))

    return F.sort_array(F.concat(*(of(i, *k) for i, k in enumerate(KINDS))))


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios of random strings against ordinary identifiers, by pair of neighbouring characters."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        return F.split(F.lit(" ".join(f"{x:.4f}" for x in self.ratios)), " ").cast("array<double>")


def _pairs(strings: DataFrame, kind: int) -> DataFrame:
    """Counts of neighbouring characters over all strings of the column ``s``; a repeated secret (``kind`` 1) is one."""
    words = strings.where(F.length("s") > 1).groupBy("s").agg((F.lit(1).cast("long") if kind else F.count("*")).alias("n"))
    pairs = words.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, F.lit(2)))).alias("pair"))
    return pairs.groupBy("pair").agg(F.sum("n").alias("n")).select("pair", "n", F.lit(kind).alias("kind"))


def train(docs: DataFrame, text_column: str = "text") -> Model:
    """Models from counts over all documents.

    Random strings are what the fixed patterns find in them, ordinary ones all their other words. Both models are
    mixed with a uniform choice of characters, by the fixed shares ``UNIFORM``: no pair has a ratio without bound as
    counts grow, and an alphabet that the found secrets lack is still known as random. A character that no string of a
    class shows is followed by any other alike. An empty table gives a model that has no preference.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    texts = docs.select(text.alias("t"))
    random = texts.select(F.explode(F.transform(base_spans(F.col("t")), lambda s: s["secret"])).alias("s"))
    clean = F.col("t")
    for _, pattern, _ in KINDS:
        clean = F.regexp_replace(clean, pattern, " ")
    plain = texts.select(F.explode(F.regexp_extract_all(clean, F.lit("([A-Za-z0-9+/_=-]+)"), F.lit(1))).alias("s"))
    size = len(ALPHABET)
    counts = [[[0] * size for _ in ALPHABET] for _ in range(2)]
    for pair, n, kind in _pairs(plain, 0).union(_pairs(random, 1)).collect():  # at most two rows per pair of characters of secrets and words
        a, b = ALPHABET.find(pair[0]), ALPHABET.find(pair[1])
        if a >= 0 and b >= 0:
            counts[kind][a][b] += n
    logs = []
    for table, share in zip(counts, UNIFORM, strict=True):
        logs.append([[math.log((1 - share) * n / sum(row) + share / size if any(row) else 1 / size) for n in row] for row in table])
    return Model(tuple(r - o for row_r, row_o in zip(logs[1], logs[0], strict=True) for r, o in zip(row_r, row_o, strict=True)))


def ratios(token: Column, model: Model) -> Column:
    """The log-likelihood ratio of every pair of neighbours in a token of the alphabet; more is more random."""
    table, size = model.column(), len(ALPHABET)

    def of(places: Column) -> Column:
        n = F.size(places) - 1
        return F.zip_with(F.slice(places, 1, n), F.slice(places, 2, n), lambda a, b: F.coalesce(F.element_at(table, (a - 1) * size + b), F.lit(0.0)))

    places = F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    return F.transform(F.array(places), of)[0]


def likelihood_ratio(token: Column, model: Model) -> Column:
    """The log-likelihood ratio of a whole token."""
    return F.aggregate(ratios(token, model), F.lit(0.0), lambda s, x: s + x)


def candidates(model: Model, threshold: float) -> str | None:
    """A pattern of tokens that may have a part that reaches ``threshold``; None if no token can.

    Such a part has at least as many pairs in favour of random as the strongest pair goes into the threshold. Tokens
    with fewer are passed over without being scored, and nothing that scoring would find is lost.
    """
    strongest, size = max(model.ratios), len(ALPHABET)
    if strongest <= 0:
        return None
    any_char = f"[{ALPHABET}]"

    def ordinary(c: str) -> str:
        row = model.ratios[ALPHABET.index(c) * size :][:size]
        favour = "".join(sorted((x for x, r in zip(ALPHABET, row, strict=True) if r > 0), key=lambda x: (x == "-", x)))
        return f"{re.escape(c)}(?![{favour}])" if favour else re.escape(c)

    order = COMMON_FIRST + "".join(c for c in ALPHABET if c not in COMMON_FIRST)
    step = "|".join(map(ordinary, order))
    return f"(?<!{any_char})(?:(?:{step})*+{any_char}){{{math.ceil(threshold / strongest)}}}+{any_char}*+"


def random_parts(token: Column, model: Model, threshold: float) -> Column:
    """``array<struct<start, end>>``, in characters of the token: what of it is random.

    That is all of a token whose ratio reaches ``threshold``. Of any other token it is every part that does, widened
    to the ``=``, ``/``, ``_`` or ``-`` around it. A part begins where its sum is highest from there, and ends where the
    sum falls by ``threshold`` from its peak, so ordinary text before, between or after secrets takes nothing from them.
    """
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    begin = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak"), F.lit(0).alias("i"), F.lit(0).alias("start"), F.lit(0).alias("end"), none.alias("out"))

    def closed(s: Column) -> Column:
        part = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(s["peak"] >= threshold, F.concat(s["out"], part)).otherwise(s["out"])

    def step(s: Column, x: Column) -> Column:
        now, i = s["sum"] + x, s["i"] + 1
        fell = now <= F.greatest(F.lit(0.0), s["peak"] - threshold)
        return F.struct(
            F.when(fell, 0.0).otherwise(now).alias("sum"),
            F.when(fell, 0.0).otherwise(F.greatest(s["peak"], now)).alias("peak"),
            i.alias("i"),
            F.when(fell, i).otherwise(s["start"]).alias("start"),
            F.when(now > s["peak"], i + 1).otherwise(s["end"]).alias("end"),
            F.when(fell, closed(s)).otherwise(s["out"]).alias("out"),
        )

    def widened(p: Column) -> Column:
        before = F.regexp_extract(F.substring(token, F.lit(1), p["start"]), "[^=/_-]*$", 0)
        after = F.regexp_extract(F.substring(token, p["end"] + 1, F.length(token)), "^[^=/_-]*", 0)
        return F.struct((p["start"] - F.length(before)).alias("start"), (p["end"] + F.length(after)).alias("end"))

    def parts(r: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("start"), F.length(token).alias("end")))
        found = F.array_distinct(F.transform(F.aggregate(r, begin, step, closed), widened))
        return F.when(F.aggregate(r, F.lit(0.0), lambda s, x: s + x) >= threshold, whole).otherwise(found)

    return F.transform(F.array(ratios(token, model)), parts)[0]


def _pieced(text: Column, spans: Column, instead) -> Column:
    """The text with ``instead(span, at)`` in place of each span and of nothing else; ``at`` is how far earlier spans reach.

    Pieces are cut from the bytes of the text, where a place is found without a walk over what is before it.
    """

    def done(x: Column) -> Column:
        def piece(s: Column, at: Column) -> Column:
            gap = F.substring(x["bytes"], at + 1, F.greatest(F.lit(0), s["from"] - at)).cast("string")
            return F.concat(gap, instead(s, at))

        before = F.slice(F.concat(F.array(F.lit(0)), x["reach"]), 1, F.size(x["reach"]))
        rest = F.substring(x["bytes"], F.element_at(x["reach"], -1) + 1, F.octet_length(x["bytes"])).cast("string")
        return F.concat(F.array_join(F.zip_with(x["spans"], before, piece), ""), rest)

    reach = running(F.transform(spans, lambda s: s["to"]), F.greatest)
    held = F.struct(text.cast("binary").alias("bytes"), spans.alias("spans"), reach.alias("reach"))
    return F.when(F.size(spans) > 0, _let(held, done)).otherwise(text)


def blanked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of every character of a span; the fixed patterns match ASCII only."""
    return _pieced(text, spans, lambda s, at: F.repeat(F.lit(" "), F.greatest(F.lit(0), s["to"] - F.greatest(at, s["from"]))))


def scan(docs: DataFrame, model: Model, text_column: str = "text", spans_column: str = "spans", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``spans``: ``array<struct<start, rank, end, kind, secret, from, to>>`` by start, then kind; ends exclusive,
    ``start`` and ``end`` in code points, ``from`` and ``to`` in bytes.

    Kinds are ``assign``, ``access`` and ``hex`` by pattern, and ``random`` for what outside of those, of any length, has
    a likelihood ratio that reaches ``threshold``: tokens, and parts of tokens. Null and empty texts have none. Rows
    are judged each by itself, so repeated rows give repeated results. Time grows with the length of a text, and with its
    matches to the power 1.5. A column that already has the name of
    ``spans_column`` is replaced.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    pattern = candidates(model, threshold)
    if pattern is None:
        return docs.withColumn(spans_column, base_spans(text))

    def random(t: Column) -> Column:
        def found(p: Column) -> Column:
            size, start = p["end"] - p["start"], t["start"] + p["start"]
            begin = t["from"] + p["start"]  # tokens are ASCII
            return span(start, len(KINDS), start + size, "random", F.substring(t["secret"], p["start"] + 1, size), begin, begin + size)

        return F.transform(random_parts(t["secret"], model, threshold), found)

    def merged(base: Column) -> Column:
        tokens = F.transform(F.array(blanked(text, base)), lambda rest: located(rest, pattern, 0))[0]
        return F.sort_array(F.concat(base, F.flatten(F.transform(tokens, random))))

    return docs.withColumn(spans_column, F.transform(F.array(base_spans(text)), merged)[0])


def listed(spans: Column) -> Column:
    """Spans as text, ``kind:start:end`` with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every span, and every run of overlapping spans, replaced by ``mask``."""
    return _pieced(text, spans, lambda s, at: F.when(s["from"] >= at, F.lit(mask)).otherwise(F.lit("")))
