"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans. The base patterns (email, ip, card, phone) give spans
that always stay; wider ones (written-out addresses, numbers without a country
code, national ids, account numbers, credentials) give further candidates. Six
labelers vote on each candidate: yes, no or nothing: its form, a gazetteer of
endings and prefixes, words before it that speak for its kind, words that speak
for something else, what it is glued to, and the variety of its characters.
Expectation-maximisation over the counts of all vote patterns (at most
kinds * 3**6 rows) estimates how reliable each labeler is and how likely each
pattern marks personal data. These chances are the soft labels from which the
final classifier is trained: naive Bayes over features of the span (its kind
with shape, length, word before, character after), counted over all
candidates into 2**FEATURE_BITS sums. Base spans and candidates that the
classifier gives at least ``accept`` are the result.

Matches are leftmost and do not overlap within a pattern; a search goes on
where the last match ended. Offsets count code points, ends are exclusive. A
candidate that overlaps a base span is left out. Null and empty texts have no
spans. Every row stands for itself, so repeated rows and null ids need no care;
other columns are carried along. Texts are searched whole.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane import scratch

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id", "account", "secret")
LABELERS = 6
FEATURE_BITS = 11
ACCEPT = 0.9
BEFORE, AFTER = 40, 2
# Spans of a text that are handled at once.
CHUNK = 256


@dataclass(frozen=True)
class Pattern:
    kind: str
    body: str
    marks: tuple[str, ...]  # a text without any of these is not searched; empty: one without digits
    # A match starts where the last one ended or after a character outside this class.
    inside: str = ""
    base: bool = False

    @property
    def expression(self) -> str:
        skip = rf"(|.*?(?<!{self.inside}))" if self.inside else "(.*?)"
        return rf"(?s)\G{skip}({self.body})(?=(.{{0,{AFTER}}}))"


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = (
    Pattern("email", rf"{_LOCAL}++@{_LABEL}++(?:\.{_LABEL}+)++", ("@",), _LOCAL, True),
    Pattern("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", (), "[0-9]", True),
    Pattern("card", r"[0-9](?:[\x20-]?[0-9])++", (), "", True),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ("+",), "", True),
    Pattern(
        "email",
        rf"{_LOCAL}++ ?[\[(] ?(?:at|AT) ?[\])] ?{_LABEL}++(?: ?[\[(] ?(?:dot|DOT) ?[\])] ?{_LABEL}++)++",
        ("(at)", "[at]", "( at )", "(AT)", "[AT]"),
        _LOCAL,
    ),
    Pattern("phone", r"(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])", (), "[0-9.-]"),
    Pattern("id", r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", (), "[0-9-]"),
    Pattern("account", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", (), "[A-Za-z0-9]"),
    Pattern("secret", r"(?<=(?:password|passwd|token|secret|api_key|apikey) ?[=:] ?[\"']?)[A-Za-z0-9_/+.-]{8,}+", ("passw", "token", "secret", "key"), ""),
    Pattern("secret", r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", ("AKIA",), "[A-Za-z0-9]"),
)

# Endings of hosts, first digits of cards, country codes, known prefixes of credentials.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]? ?)(?:com|org|net|edu|gov|info|biz|io|dev|co|de|fr|es|it|nl|uk|us|ch|at|eu)$",
    "ip": r"^(?:[1-9][0-9]|[12][0-9]{2})\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
    "id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "account": r"^(?:AT|BE|CH|DE|ES|FR|GB|IE|IT|LU|NL|PL|PT|SE)",
    "secret": r"^(?:AKIA|ghp_|sk-|xox[bp]-|eyJ)|^[0-9a-f]{12,}$",
}
SPEAKS_FOR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel|reach)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|from|client|login)\b",
    "card": r"(?i)\b(?:card|visa|credit|karte|carte|tarjeta|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|dial)\b",
    "id": r"(?i)\b(?:ssn|social security|national id|tax id)\b",
    "account": r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)\b",
    "secret": r"(?i)(?:password|passwd|token|secret|key)",
}
SPEAKS_AGAINST = r"(?i)\b(?:version|v|isbn|issn|licen[cs]e|section|chapter|page|figure|table|order|invoice|serial|sku|part|build|release|total)\b[^A-Za-z0-9]{0,4}$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a text of digits is right."""
    turned = F.reverse(digits)
    value = lambda i: F.substring(turned, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i) - F.when(value(i) > 9, 9).otherwise(0))
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern passes its check."""
    if kind == "ip":
        return F.regexp_like(value, F.lit(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"))
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _votes(p: Pattern, value: Column, before: Column, after: Column) -> Column:
    like = lambda c, pattern: F.regexp_like(c, F.lit(pattern))
    form = F.lit(1 if p.base else 0) if p.kind != "account" else F.when(F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34), 1).otherwise(-1)
    alnum = r"[A-Za-z0-9]"
    plain = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    return F.array(
        form.cast("int"),
        F.when(like(value, GAZETTEER[p.kind]), 1).otherwise(-1 if p.kind in ("id", "account") else 0),
        F.when(like(before, SPEAKS_FOR[p.kind]), 1).otherwise(0),
        F.when(like(before, SPEAKS_AGAINST), -1).otherwise(0),
        F.when(like(before, alnum + "$") | like(after, "^" + alnum), -1).otherwise(1),
        F.when(F.size(F.array_distinct(F.split(plain, ""))) <= 2, -1).otherwise(1),
    )


def _features(p: Pattern, value: Column, before: Column, after: Column) -> Column:
    """Numbers of the span's features."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[A-Z]+", "A"), "[a-z]+", "a")
    word = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    parts = [
        F.concat(F.lit(f"{p.kind} shape "), F.substring(shape, 1, 24)),
        F.concat(F.lit(f"{p.kind} length "), F.least(F.length(value), F.lit(40)).cast("string")),
        F.concat(F.lit(f"{p.kind} before "), word),
        F.concat(F.lit(f"{p.kind} after "), F.substring(after, 1, 1)),
    ]
    return F.array(*(F.pmod(F.xxhash64(x), F.lit(1 << FEATURE_BITS)).cast("int") for x in parts))


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _chunks(values: Column) -> Column:
    """An array cut into arrays of CHUNK, so that work on pairs and growing arrays is done on short ones."""
    last = F.floor((F.size(values) - 1) / CHUNK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda c: F.slice(values, c * CHUNK + 1, CHUNK))
    return F.filter(cut, lambda c: F.size(c) > 0)


def _ends(sizes: Column, start: Column) -> Column:
    """Running sums of an array, from ``start`` on."""
    return F.aggregate(
        sizes,
        F.struct(start.alias("at"), F.array().cast("array<int>").alias("ends")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["ends"], F.array(acc["at"] + n)).alias("ends")),
    )["ends"]


def _running(sizes: Column) -> Column:
    """Running sums of an array of any length: of its chunks, then within each."""

    def within(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, n: a + n))
        return F.flatten(F.zip_with(chunks, F.zip_with(_ends(totals, F.lit(0)), totals, lambda e, n: e - n), _ends))

    return _let(_chunks(sizes), within)


def _spans(p: Pattern, text: Column) -> Column:
    """All matches of one pattern: kind, start, end, base, votes, features."""
    gaps, values, afters = (F.regexp_extract_all(text, F.lit(p.expression), F.lit(i)) for i in (1, 2, 3))
    rows = F.arrays_zip(gaps.alias("gap"), values.alias("value"), afters.alias("after"))
    return _let(rows, lambda rows: _placed(p, rows))


def _placed(p: Pattern, rows: Column) -> Column:
    ends = _running(F.transform(rows, lambda r: F.length(r["gap"]) + F.length(r["value"])))
    whole = F.zip_with(
        rows,
        ends,
        lambda r, e: F.struct(r["gap"].alias("gap"), r["value"].alias("value"), r["after"].alias("after"), (e - F.length(r["value"])).alias("start")),
    )
    return F.transform(
        F.filter(whole, lambda r: _holds(p.kind, r["value"])) if p.base else whole,
        lambda r: F.struct(
            r["start"].alias("start"),
            F.lit(KINDS.index(p.kind)).alias("kind"),
            (r["start"] + F.length(r["value"])).alias("end"),
            F.lit(p.base).alias("base"),
            _votes(p, r["value"], F.right(r["gap"], F.lit(BEFORE)), r["after"]).alias("votes"),
            _features(p, r["value"], F.right(r["gap"], F.lit(BEFORE)), r["after"]).alias("features"),
        ),
    )


_KIND = "array<struct<start int, kind int, end int, base boolean, votes array<int>, features array<int>>>"


def candidates(docs: DataFrame, text: str = "text") -> Column:
    """Array of all candidates of a text, by start and kind."""
    body = F.coalesce(F.col(text), F.lit(""))

    def searched(p: Pattern) -> Column:
        has = F.regexp_like(body, F.lit("[0-9]")) if not p.marks else F.lit(False)
        for m in p.marks:
            has = has | F.contains(body, F.lit(m))
        return F.when(has, _spans(p, body).cast(_KIND)).otherwise(F.array().cast(_KIND))

    base = F.concat(*(searched(p) for p in PATTERNS if p.base))
    more = F.concat(*(searched(p) for p in PATTERNS if not p.base))
    return _let(F.array_sort(base), lambda base: F.array_sort(F.concat(base, _free(more, base))))


def _free(more: Column, base: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``, which is sorted by start; looked up by chunks of it."""

    def looked_up(chunks: Column) -> Column:
        def taken(m: Column) -> Column:
            meets = lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])
            return F.exists(chunks, lambda c: meets(c) & F.exists(c["spans"], meets))

        return F.filter(more, lambda m: ~taken(m))

    bounds = F.transform(
        _chunks(base),
        lambda c: F.struct(F.element_at(c, 1)["start"].alias("start"), F.array_max(F.transform(c, lambda s: s["end"])).alias("end"), c.alias("spans")),
    )
    return _let(bounds, looked_up)


def _pattern_number(span: Column) -> Column:
    return F.aggregate(span["votes"], span["kind"], lambda a, v: a * 3 + v + 1)


def reliabilities(counts: dict[int, int], rounds: int = 50) -> tuple[dict[int, float], list[float]]:
    """Chance that each vote pattern marks personal data, and each labeler's reliability.

    A labeler that votes is right with its reliability, whatever the kind;
    each kind has its own share of personal data. Reliabilities start at 0.8.
    """

    def votes(number: int) -> tuple[int, list[int]]:
        out = []
        for _ in range(LABELERS):
            number, v = divmod(number, 3)
            out.append(v - 1)
        return number, out[::-1]

    rows = [(n, *votes(n), c) for n, c in sorted(counts.items())]
    right, share = [0.8] * LABELERS, dict.fromkeys(range(len(KINDS)), 0.5)
    chance: dict[int, float] = {}
    for _ in range(rounds):
        for n, kind, vs, _c in rows:
            odds = math.log(share[kind] / (1 - share[kind]))
            odds += sum(v * math.log(right[j] / (1 - right[j])) for j, v in enumerate(vs))
            chance[n] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for j in range(LABELERS):
            cast = [(chance[n] if vs[j] > 0 else 1 - chance[n], c) for n, _, vs, c in rows if vs[j]]
            total = sum(c for _, c in cast)
            right[j] = min(0.99, max(0.5, (sum(p * c for p, c in cast) + 8) / (total + 10)))
        for k in share:
            mine = [(chance[n], c) for n, kind, _, c in rows if kind == k]
            share[k] = (sum(p * c for p, c in mine) + 1) / (sum(c for _, c in mine) + 2)
    return chance, right


def _constant(values: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps([round(v, 9) for v in values])), "array<double>")


def find(docs: DataFrame, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` without ``text`` and with spans: array of (kind, start, end, base, score) by start and kind.

    Columns named spans, in any case, are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in {text.lower(), "spans"}]
    marked = scratch.durable(docs.select(*kept, candidates(docs, text).alias("spans")), "candidates")
    each = marked.select(F.explode("spans").alias("s"))
    numbers = each.groupBy(_pattern_number(F.col("s")).alias("number")).agg(F.count(F.lit(1)).alias("n"))
    chance, _ = reliabilities({r["number"]: r["n"] for r in numbers.collect()})
    chances = _constant([chance.get(n, 0.5) for n in range(len(KINDS) * 3**LABELERS)])

    soft = F.element_at(chances, _pattern_number(F.col("s")) + 1)
    sums = each.select(F.explode("s.features").alias("feature"), soft.alias("p")).groupBy("feature").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")
    )
    weights = [0.0] * (1 << FEATURE_BITS)
    rows = sums.collect()
    yes, no = sum(r["yes"] for r in rows) + 1, sum(r["no"] for r in rows) + 1
    for r in rows:
        # Two pseudo-counts at the overall share: a rare feature says little.
        usual = 2 * yes / (yes + no)
        weights[r["feature"]] = math.log((r["yes"] + usual) / (r["no"] + 2 - usual)) - math.log(yes / no)
    table, prior = _constant(weights), math.log(yes / no)
    odds = lambda s: F.aggregate(s["features"], F.lit(prior), lambda a, f: a + F.element_at(table, f + 1))
    scored = F.transform(
        "spans",
        lambda s: F.struct(
            F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["base"].alias("base"),
            (1 / (1 + F.exp(-odds(s)))).alias("score"),
        ),
    )
    return marked.select(*kept, F.filter(scored, lambda s: s["base"] | (s["score"] >= accept)).alias("spans"))


def listing(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
