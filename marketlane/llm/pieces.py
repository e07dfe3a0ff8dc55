"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into marked words: runs of the mark (a space, or the mark itself)
with the characters up to the next. No piece of a model that this reader takes
runs over such a cut, so words are encoded on their own. Each task sorts the
distinct words it has not met into a trie order and walks it depth first; the
forward scores of a prefix are kept while its extensions are visited, so words
with a common prefix share them.

For a unigram model the forward score of a prefix is the best sum of piece
scores and the back pointer its last piece. For a BPE model the scores are
merge ranks, which do not add up; there a path scores 0 if each two
neighbouring pieces are what merging their joined text gives, and is
impossible otherwise. Just one possible path ends at each prefix, and it is the
result of the merges, so the ids equal those of the public library.

Characters that no piece covers become byte pieces (or the unknown piece of a
model without them). The model file is read where the query is built, by a path
that the caller gives; tasks get its pieces. Null and empty texts have no ids.
Decoding gives the text back, but for the mark itself, which turns into a
space, and for characters lost to the unknown piece. Texts are encoded whole.
Repeated rows are encoded alike; other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\u2581"
# Bytes of words and their ids that a worker remembers, by a count of their objects; the least used are let go.
REMEMBERED = 96 << 20
# Neighbouring pieces whose border a worker remembers.
PAIRS = 200_000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_COST = 10.0


@dataclass(frozen=True)
class Vocabulary:
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]  # empty for a model without byte pieces
    unknown: int
    merges: bool  # a BPE model
    prefix: bool  # a mark is put before the text
    pieces: tuple[bytes, ...]  # text of each id, for decoding


def read(path: str = MODEL, merges: bool = True, prefix: bool = True) -> Vocabulary:
    """The pieces of a model file with identity normalisation; ``merges`` says that it is a BPE model."""
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    odd = "\ufb01  \u2460 e\u0301"
    if m.normalize(odd).lstrip(MARK) != odd.replace(" ", MARK):
        raise ValueError("this model changes characters before it encodes them")
    plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    names = {m.id_to_piece(i): i for i in plain}
    if any(MARK in p.lstrip(MARK) for p in names):
        raise ValueError("a piece of this model runs over a word's start")
    in_bytes = tuple(m.piece_to_id(f"<0x{b:02X}>") for b in range(256)) if m.is_byte(m.piece_to_id("<0x00>")) else ()
    text = [b""] * n
    for p, i in names.items():
        text[i] = p.replace(MARK, " ").encode()
    for b, i in enumerate(in_bytes):
        text[i] = bytes([b])
    text[m.unk_id()] = " \u2047 ".encode()
    return Vocabulary(names, {p: m.get_score(i) for p, i in names.items()}, in_bytes, m.unk_id(), merges, prefix, tuple(text))


def merged(v: Vocabulary, symbols: list[str], edges: tuple[list, list] | None = None) -> list[str]:
    """The symbols after merging, best score first and leftmost of equals.

    ``edges`` takes the first and the last symbols that were merged away, each
    with the least score so far.
    """
    least = np.inf
    while len(symbols) > 1:
        best = max((v.scores.get(a + b, -np.inf), -k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])))
        if best[0] == -np.inf:
            break
        k, least = -best[1], min(least, best[0])
        if edges is not None:
            if k == 0:
                edges[0].append((symbols[0], least))
            if k == len(symbols) - 2:
                edges[1].append((symbols[-1], least))
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
    return symbols


class Encoder:
    """Ids of words; one for each worker process and vocabulary."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.longest = max(map(len, v.ids), default=1)
        # Words met lately, and those met before them; a word that is met again moves to the first.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = 0
        # Pieces that merging their characters yields, with their edges; None for others, which never occur.
        self.edges: dict[str, tuple[list, list] | None] = {}
        # For a piece on the left, whether the one on the right fits.
        self.met: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.floor = min(v.scores.values(), default=0.0) - UNKNOWN_COST
        # Ids of pieces of several characters, None before their merges were tried, and of single characters.
        self.whole: dict[str, bytes | None] = {p: None for p in v.ids if len(p) > 1}
        self.single: dict[str, bytes] = {}
        # How long a piece can be that ends in two given characters.
        self.reach: dict[str, int] = {}
        for p in self.whole:
            self.reach[p[-2:]] = max(self.reach.get(p[-2:], 0), len(p))

    def _char(self, c: str) -> bytes:
        if c not in self.single:
            if len(self.single) > PAIRS:
                self.single.clear()
            i = self.v.ids.get(c)
            ids = [i] if i is not None else [self.v.byte_ids[b] for b in c.encode()] if self.v.byte_ids else [self.v.unknown]
            self.single[c] = np.array(ids, np.int32).tobytes()
        return self.single[c]

    def _edges(self, piece: str) -> tuple[list, list] | None:
        """What stands at the piece's start and end while it is merged, each with the score that ends it."""
        if piece not in self.edges:
            both: tuple[list, list] = ([], [])
            whole = merged(self.v, [*piece], both) == [piece]
            self.edges[piece] = tuple([*e, (piece, -np.inf)] for e in both) if whole else None
        return self.edges[piece]

    def fits(self, a: str, b: str) -> bool:
        """Whether merging the characters of both pieces gives just these two.

        It does unless, at some time, the symbols on either side of the border
        merge before either of them is merged away from it.
        """
        right, left = self._edges(a)[1], self._edges(b)[0]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = right[i], left[j]
            score = self.v.scores.get(x + y, -np.inf)
            if score > x_ends and score >= y_ends and score > -np.inf:
                return False
            if x_ends >= y_ends:
                i += 1
            else:
                j += 1
            if i == len(right) or j == len(left):
                return True

    def _merged(self, word: str, last: list, ids: list[bytes]) -> None:
        """For the prefixes of ``word`` beyond those at hand, the last piece (with what fits to its right) and all ids.

        Of a BPE model just one path to each prefix is possible, so the first
        piece that fits ends it.
        """
        whole, reach, fits = self.whole, self.reach, self.fits
        if self.pairs > PAIRS:
            self.met, self.pairs = {}, 0
        met = self.met
        for end in range(len(last), len(word) + 1):
            start = end - reach.get(word[end - 2 : end], 1) if end > 1 else 0
            if start < 0:
                start = 0
            while end - start > 1:
                p = word[start:end]
                if p in whole:
                    body = whole[p]
                    if body is None:
                        if self._edges(p) is None:
                            del whole[p]
                            start += 1
                            continue
                        body = whole[p] = np.array([self.v.ids[p]], np.int32).tobytes()
                    if start == 0:
                        break
                    a, known = last[start]
                    found = known.get(p)
                    if found is None:
                        found = known[p] = fits(a, p)
                        self.pairs += 1
                    if found:
                        break
                start += 1
            else:
                p = word[start:end]
                body = self._char(p)
            known = met.get(p)
            if known is None:
                known = met[p] = {}
            last.append((p, known))
            ids.append(ids[start] + body)

    def _best(self, word: str, last: list, ids: list[bytes]) -> None:
        """For the prefixes of ``word`` beyond those at hand, the best sum of scores and all ids of its path."""
        scores, floor, longest = self.v.scores, self.floor, self.longest
        for end in range(len(last), len(word) + 1):
            best, at = -np.inf, end - 1
            for start in range(max(0, end - longest), end):
                p = word[start:end]
                if end - start > 1 and p not in scores:
                    continue
                total = last[start] + scores.get(p, floor)
                if total > best:
                    best, at = total, start
            p = word[at:end]
            body = self._char(p) if len(p) == 1 else np.array([self.v.ids[p]], np.int32).tobytes()
            last.append(best)
            ids.append(ids[at] + body)

    def learn(self, words: set[str]) -> None:
        """Encode words not met before, in trie order; the results of a prefix are kept while its extensions follow."""
        if self.held > REMEMBERED // 2:
            self.known, self.before, self.held = {}, self.known, 0
        known, before = self.known, self.before
        fresh = []
        for w in words:
            if w not in known:
                ids = before.get(w)
                if ids is None:
                    fresh.append(w)
                else:
                    known[w] = ids
                    self.held += 200 + 2 * len(w) + len(ids)
        fresh.sort()
        extend = self._merged if self.v.merges else self._best
        last: list = [("", {}) if self.v.merges else 0.0]
        done: list[bytes] = [b""]
        old = ""
        for word in fresh:
            shared = 0
            for a, b in zip(old, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], done[shared + 1 :]
            extend(word, last, done)
            known[word] = done[-1]
            self.held += 200 + 2 * len(word) + len(done[-1])
            old = word

    def cut(self, text: str) -> list[str]:
        """The marked words of a text."""
        if not text:
            return []
        body = text.replace(" ", MARK)
        if self.v.prefix:
            body = MARK + body
        if MARK + MARK not in body and body[0] == MARK:
            return [MARK + w for w in body.split(MARK)[1:]]
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", body)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cuts = [self.cut(t or "") for t in texts]
        self.learn(set(chain.from_iterable(cuts)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, c)), np.int32) for c in cuts]


_encoders: list[Encoder] = []


def encoder(v: Vocabulary) -> Encoder:
    """The encoder of a worker process, made anew for another vocabulary."""
    if not _encoders or _encoders[0].v != v:
        _encoders[:] = [Encoder(v)]
    return _encoders[0]


def decoded(v: Vocabulary, ids: np.ndarray | list[int]) -> str:
    text = b"".join(map(v.pieces.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if v.prefix and text[:1] == " " else text


def encode_udf(v: Vocabulary) -> Callable[[Column], Column]:
    """ids, and whether decoding them gives the text back, for a column of texts."""

    @F.arrow_udf("struct<ids: array<int>, lossless: boolean>")
    def run(texts: pa.Array) -> pa.Array:
        e = encoder(v)
        out, same, sizes = [], [], [0]
        for at in range(0, len(texts), 1024):
            part = texts[at : at + 1024].to_pylist()
            for t, ids in zip(part, e.encode(part)):
                out.append(ids)
                sizes.append(len(ids))
                same.append(decoded(v, ids.tolist()) == (t or ""))
        lists = pa.ListArray.from_arrays(
            pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(out) if out else np.zeros(0, np.int32))
        )
        return pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], names=["ids", "lossless"])

    return run


def decode_udf(v: Vocabulary) -> Callable[[Column], Column]:
    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        return pa.array([decoded(v, x or []) for x in ids.to_pylist()], pa.string())

    return run


def encode(docs: DataFrame, v: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ids, n_tokens and lossless; columns of these names, in any case, are replaced."""
    names = [c for c in docs.columns if c.lower() not in {"ids", "n_tokens", "lossless"}]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    out = docs.select(row, encode_udf(v)(F.col(f"`{text}`")).alias("out"))
    return out.select(
        *[F.col(f"row.`{c}`").alias(c) for c in names],
        F.col("out.ids").alias("ids"),
        F.size("out.ids").cast("long").alias("n_tokens"),
        F.col("out.lossless").alias("lossless"),
    )


def decode(encoded: DataFrame, v: Vocabulary, ids: str = "ids", to: str = "text") -> DataFrame:
    return encoded.withColumn(to, decode_udf(v)(F.col(ids)))
