"""URL filter: pattern rules found through their rarest literal token.

A rule is a short text. ``||`` at its start stands for the start of the host
or of any label of it, ``|`` for the start or end of the address, ``*`` for any
run of characters and ``^`` for one separator or the end; all else is literal.
Rules are matched against host, path, query and fragment written one after the
other, so ``||example.org/en/`` fits that host and its subdomains below /en/.

Whole words of a rule (letters and digits between separators) are its tokens.
The index keeps a rule under the token that the fewest addresses have, counted
over all of them. An address looks up its own words and runs the expressions
of the rules found there, and of rules that have no token, and no others.
The index is one constant made from the rules, which the caller gives as a
Python sequence; addresses are neither shuffled nor joined.

Among the listed rules that fit, the longest text decides; of equally long ones
the text that sorts last. Where none fits, any fitting pattern rule blocks, and
else the address is allowed. A null address, or one without ``://``, has empty
host and path and no words, fits no rule that has a token, and is judged like
any other. Repeated rows are judged alike, an empty table gives none, columns of
any other name are carried along unless they are named like a result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"

# Pattern rules used where the caller gives none: hosts and paths of adverts, betting and pill shops.
PATTERNS = (
    "||ads-track.",
    "||adserver.",
    "||casino-win.",
    "||cheap-pills.",
    "||free-bets.",
    "-casino.",
    "/adclick^",
    "/ads/",
    "/banners/",
    "/popunder^",
    "^affiliate_id=",
)


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str = BLOCK
    listed: bool = False

    @property
    def pattern(self) -> str:
        body, start, end = self.text, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"^(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], "$"
        special = {"*": ".*", "^": SEPARATOR}
        return "(?s)" + start + "".join(special.get(c) or re.escape(c) for c in body) + end

    @property
    def tokens(self) -> list[str]:
        """Words that every address the rule fits has whole."""
        body = self.text.removeprefix("||").removeprefix("|").removesuffix("|")
        found = []
        for m in re.finditer("[A-Za-z0-9]+", body):
            open_left = m.start() == 0 and not self.text.startswith("|") or body[: m.start()].endswith("*")
            open_right = m.end() == len(body) and not self.text.endswith("|") or body[m.end() :].startswith("*")
            if not (open_left or open_right):
                found.append(m.group().lower())
        return sorted(set(found))


def listed(allow: Sequence[str] = (), block: Sequence[str] = ()) -> list[Rule]:
    """Rules of ``host/path`` texts, which fit the host with its subdomains and paths that start so."""
    return [Rule("||" + t, ALLOW, True) for t in allow] + [Rule("||" + t, BLOCK, True) for t in block]


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and query with fragment; empty where there are none."""
    cut = [F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)(.*)", i), F.lit("")) for i in (1, 2, 3)]
    return F.translate(cut[0], UPPER, LOWER), cut[1], cut[2]


def words(subject: Column) -> Column:
    return F.array_distinct(F.split(F.translate(subject, UPPER, LOWER), "[^a-z0-9]+"))


def token_counts(addresses: DataFrame, rules: Sequence[Rule], subject: str = "_subject") -> dict[str, int]:
    """In how many of all addresses each rule token stands; at most one entry for each token of the rules."""
    known = sorted({t for r in rules for t in r.tokens})
    found = addresses.select(F.explode(words(F.col(subject))).alias("token")).where(F.col("token").isin(known))
    return {r["token"]: r["rows"] for r in found.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).collect()}


def index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[Column, int]:
    """The rules by checksum of their rarest token, as one constant array of lists, and its length."""
    size = 1 << max(4, (2 * len(rules)).bit_length())
    slots: list[list[dict]] = [[] for _ in range(size)]
    for r in rules:
        token = min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        text = r.text.removeprefix("||") if r.listed else r.text
        entry = {"token": token, "pattern": r.pattern, "size": len(text), "text": text, "verdict": r.verdict}
        slots[zlib.crc32(token.encode()) % size].append(entry | {"listed": r.listed})
    kind = "array<array<struct<token string, pattern string, size int, text string, verdict string, listed boolean>>>"
    return F.from_json(F.lit(json.dumps(slots)), kind), size


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the deciding listed rule or null), verdict and n_rules (that fitted).

    Columns of these names, in any case, are replaced.
    """
    host, path, rest = parts(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict", "n_rules"}]
    # The columns travel in one, so that none can clash with those added here.
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    addresses = pages.select(row, host.alias("host"), path.alias("path"), F.concat(host, path, rest).alias("_subject"))
    table, size = index(rules, token_counts(addresses, rules))

    def fetched(token: Column) -> Column:
        slot = F.element_at(table, (F.crc32(token) % size + 1).cast("int"))
        return F.filter(F.coalesce(slot, F.array()), lambda r: r["token"] == token)

    # Rules without a token stand under the empty word, which every address looks up.
    tokens = F.array_union(words(F.col("_subject")), F.array(F.lit("")))
    candidates = F.flatten(F.transform(tokens, fetched))
    hits = F.filter(candidates, lambda r: F.regexp_like(F.col("_subject"), r["pattern"]))
    best = F.array_max(
        F.transform(F.filter("_hits", lambda r: r["listed"]), lambda r: F.struct(r["size"], r["text"], r["verdict"]))
    )
    return (
        addresses.withColumn("_hits", hits)
        .withColumn("_best", best)
        .select(
            *[F.col(f"row.`{c}`").alias(c) for c in kept],
            "host",
            "path",
            F.col("_best.text").alias("rule"),
            F.coalesce(
                F.col("_best.verdict"),
                F.when(F.exists("_hits", lambda r: ~r["listed"] & (r["verdict"] == BLOCK)), BLOCK).otherwise(ALLOW),
            ).alias("verdict"),
            F.size("_hits").alias("n_rules"),
        )
    )
