"""Token counts at every prefix of a text, by dynamic programming over a byte-pair vocabulary.

The encoding of a string ends in one determined token, and it is the encoding of what stands
before that token plus the token.  So one pass over the positions of a string, keeping the last
token and the count at each, gives the count of every prefix; a token may follow another if
encoding the two together leaves them as they are.  Texts are cut at the vocabulary's word
borders into units (white space and what follows it), whose prefix counts do not depend on the
rest of the text and are kept for reuse.  Per text the result is a string of one signed byte per
character: the change of the count at that character.  Truncation and budget questions are
running sums over it (``count_at``, ``longest_prefix``) and need no second encoding: ``read_counts`` answers
them from the stored table.

Defined cases: null counts as the empty text (0 bytes, 0 tokens); the vocabulary's special strings
inside a text are one token, counted at their last character, with the count of the cut
string before it; other columns, repeated rows and empty tables pass through.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shipping import shipped
from meterlake.llm.wordhash import slices

#: Units kept per worker; beyond it the store starts anew (results do not depend on it).
UNITS = 400_000
#: Bytes of text, or of stored prefixes, worked on at a time.
BATCH_BYTES = 4 << 20
PAIRS = 400_000
STATES = 600_000
#: Longer units are computed each time instead of kept.
UNIT_CHARS = 64

# The word pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same language cut into units: white space belongs to what follows it.  A contraction is one
# after nothing or after white space that does not end in a plain blank, which would take its apostrophe.
UNIT = r"\s*(?:\p{L}+|\p{N}+)|(?:\s*[^\S ])?(?:'s|'t|'re|'ve|'m|'ll|'d)|\s*[^\s\p{L}\p{N}]+|\s+"


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: printable bytes stand for themselves,
    the others are numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    def __init__(self, path: str):
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(merges)}
        special = {x["content"] for x in spec["added_tokens"]}
        self.vocab = {as_bytes(t) for t in spec["model"]["vocab"] if t not in special}
        self.longest = max(map(len, self.vocab))
        self.words = regex.compile(PATTERN)
        self.units = regex.compile(UNIT)
        self.blank = regex.compile(r"\s*")
        self.special = sorted(special)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.kept: dict[str, tuple[int, bytes]] = {}
        self.made = {a + b: (a, b) for a, b in self.rank}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.states: dict[bytes, tuple[bytes, int]] = {}
        self.edges: dict[tuple[bytes, bool], tuple] = {}
        self.stands = functools.lru_cache(maxsize=1 << 17)(lambda t: len(self._merge(t)) == 1)

    def _merge(self, text: bytes) -> list[bytes]:
        """Encoding of a short string: join the pair of lowest rank, leftmost first, until none is left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        none = len(self.rank)
        ranks = [self.rank.get(p, none) for p in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = self.rank.get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = self.rank.get((parts[i - 1], parts[i]), none)
        return parts

    def edge(self, token: bytes, right: bool) -> tuple:
        """The pieces at one end of a token while it is being merged, each with the rank at which
        the next one takes it up, from the single byte to the whole token."""
        known = self.edges.get((token, right))
        if known is None:
            steps, piece, rank = [], token, len(self.rank)
            while True:
                steps.append((piece, rank))
                if len(piece) == 1:
                    break
                pair = self.made[piece]
                rank, piece = self.rank[pair], pair[right]
            known = self.edges[(token, right)] = tuple(reversed(steps))
        return known

    def follows(self, a: bytes, b: bytes) -> bool:
        """Whether encoding a + b gives a, b: no merge across the border comes before the merges
        that take up its two neighbours.  At equal rank the left one is merged first."""
        xs, ys, rank = self.edge(a, True), self.edge(b, False), self.rank
        i = j = 0
        none = len(rank)
        if (a, b) in rank:
            return False
        while True:
            x, rx = xs[i]
            y, ry = ys[j]
            across = rank.get((x, y), none)
            if across < none and across < rx and across <= ry:
                return False
            if rx <= ry:
                if rx == none:
                    return True
                i += 1
            else:
                j += 1

    def word_counts(self, word: bytes) -> list[int]:
        """Tokens of each prefix of one word, in bytes; entry i is for word[:i]."""
        n = len(word)
        last: list[bytes] = [b""] * (n + 1)
        count = [0] * (n + 1)
        vocab, pairs, states = self.vocab, self.pairs, self.states
        begin = 0
        for i in range(1, n + 1):
            if i <= UNIT_CHARS:  # words share their beginnings, and a state depends on nothing else
                state = states.get(word[:i])
                if state is not None:
                    last[i], count[i] = state
                    begin = i - len(last[i])
                    continue
            # Exactly one token fits; mostly it goes on from the last one, or it is short.
            low = max(0, i - self.longest)
            for j in (max(begin, low), *range(i - 1, low - 1, -1)):
                t = word[j:i]
                if t not in vocab:
                    continue
                if j:
                    ok = pairs.get((last[j], t))
                    if ok is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        ok = pairs[last[j], t] = self.follows(last[j], t)
                else:
                    ok = self.stands(t)
                if ok:
                    last[i], count[i], begin = t, count[j] + 1, j
                    break
            else:
                raise AssertionError("every byte is a token")
            if i <= UNIT_CHARS:
                if len(states) >= STATES:
                    states.clear()
                states[word[:i]] = (last[i], count[i])
        return count

    def _string_counts(self, text: str) -> int:
        return sum(self.word_counts(w.encode())[-1] for w in self.words.findall(text))

    def unit(self, text: str) -> tuple[int, bytes]:
        """Tokens of a unit, and the change of the count at each of its characters."""
        known = self.kept.get(text)
        if known is not None:
            return known
        words = self.words.findall(text)
        if len(words) == 1 and text.isascii() and not (text[0] == "'" and len(text) == 3):
            by_byte = self.word_counts(text.encode())
            out = (by_byte[-1], bytes([(b - a) & 255 for a, b in zip(by_byte, by_byte[1:])]))
            if len(text) <= UNIT_CHARS:
                if len(self.kept) >= UNITS:
                    self.kept.clear()
                self.kept[text] = out
            return out
        counts = [0] * (len(text) + 1)
        total = 0
        for w in self.words.finditer(text):
            body, base, at = w.group(), total, 0
            by_byte = self.word_counts(body.encode())
            for k, c in enumerate(body, 1):
                at += len(c.encode())
                counts[w.start() + k] = base + by_byte[at]
            total = base + by_byte[-1]
        # Inside white space, and inside a contraction, a prefix is cut into words differently.
        blank = self.blank.match(text).end()  # the pattern's white space; strip takes more
        if 1 < blank < len(text):
            run = self.word_counts(text[:blank].encode())
            at = 0
            for k in range(1, blank + 1):
                at += len(text[k - 1].encode())
                counts[k] = run[at]
        if len(text) == blank + 3 and text[blank] == "'":
            counts[blank + 2] = self._string_counts(text[: blank + 2])
        out = (counts[-1], bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])]))
        if len(text) <= UNIT_CHARS:
            if len(self.kept) >= UNITS:
                self.kept.clear()
            self.kept[text] = out
        return out

    def deltas(self, text: str) -> bytes:
        """One signed byte per character of ``text``."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts, at = [], 0
        for m in self.cut.finditer(text):
            parts.append(self._plain(text[at : m.start()]))
            # A prefix that ends inside the special string is plain text up to there.
            plain = np.frombuffer(self._plain(text[at : m.end()]), np.int8)
            before = np.frombuffer(parts[-1], np.int8).sum(dtype=np.int64)
            inside = np.diff(plain.cumsum(dtype=np.int64)[m.start() - at :], prepend=before) if m.end() - m.start() > 1 else np.zeros(1, np.int64)
            inside[-1] = 1 - inside[:-1].sum()
            parts.append(inside.astype(np.int8).tobytes())
            at = m.end()
        parts.append(self._plain(text[at:]))
        return b"".join(parts)

    def _plain(self, text: str) -> bytes:
        kept, unit = self.kept, self.unit
        out = []
        for u in self.units.findall(text):
            known = kept.get(u)
            out.append(known[1] if known is not None else unit(u)[1])
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_at(deltas: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` characters."""
    return int(np.frombuffer(deltas[:chars], np.int8).sum(dtype=np.int64))


def longest_prefix(deltas: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    total = np.cumsum(np.frombuffer(deltas, np.int8), dtype=np.int64)
    fits = np.flatnonzero(total <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


@shipped
def read_counts(store: DataFrame, budget: int) -> DataFrame:
    """``store`` without its prefixes, with n_tokens, over_limit (more than ``budget`` tokens) and
    fitting_chars (the longest prefix within the budget), all from the stored counts."""
    rest = [c for c in store.columns if c not in ("prefixes", "n_tokens", "over_limit", "fitting_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "prefixes", BATCH_BYTES):
                n_tokens, fitting = [], []
                for x in part.column("prefixes"):
                    d = zlib.decompress(x.as_py())
                    n_tokens.append(count_at(d, len(d)))
                    fitting.append(len(d) if n_tokens[-1] <= budget else longest_prefix(d, budget))
                cols = [pa.array(n_tokens, pa.int64()), pa.array([n > budget for n in n_tokens]), pa.array(fitting, pa.int64())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *cols], [*rest, "n_tokens", "over_limit", "fitting_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in store.select(*rest).schema]
    return store.select(*rest, "prefixes").mapInArrow(run, ", ".join([*fields, "n_tokens long", "over_limit boolean", "fitting_chars long"]))


@shipped
def prefix_table(docs: DataFrame, path: str, keep_prefixes: bool = True) -> DataFrame:
    """``docs`` without its text, with n_bytes, n_tokens and (zlib) ``prefixes``.

    ``path`` has to name the vocabulary on every executor.
    """
    rest = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "prefixes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(path)
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                n_bytes, n_tokens, prefixes = [], [], []
                for x in batch.column("text"):
                    text = x.as_py() or ""
                    d = table.deltas(text)
                    n_bytes.append(len(text.encode()))
                    n_tokens.append(int(np.frombuffer(d, np.int8).sum(dtype=np.int64)))
                    if keep_prefixes:
                        prefixes.append(zlib.compress(d, 1))
                cols = [batch.column(c) for c in rest] + [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
                names = rest + ["n_bytes", "n_tokens"]
                if keep_prefixes:
                    cols.append(pa.array(prefixes, pa.binary()))
                    names.append("prefixes")
                yield pa.RecordBatch.from_arrays(cols, names)

    fields = docs.select(*rest).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_bytes long", "n_tokens long"] + ["prefixes binary"] * keep_prefixes)
    return docs.select(*rest, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
