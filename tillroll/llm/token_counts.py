"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair vocabulary with an end-of-word mark encodes each pre-token by itself.
Within one pre-token the encoding of a prefix ends in exactly one token ``t``: the
one for which the prefix without ``t`` ends in a token compatible with ``t``, that
is, encoding both together gives both again. So

    count[i] = count[i - len(t)] + 1

and one pass over the pre-token gives the exact count at each of its prefixes, both
as they stand within the word and with the end of the word there. Over a text the
counts of its pre-tokens add up. The counts of all prefixes are stored: how many
tokens a prefix has and where a token budget ends are looked up, with nothing
encoded anew.

White space separates pre-tokens always, so counts are kept by white-space
delimited chunk in a bounded memory per worker. Only places inside a letter with
its combining marks, where no text is cut but by mistake, are encoded one by one.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows are
each counted; other columns pass through, and result names replace input columns
of the same name.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import prepare_workers, read_table, reserved

#: Chunks and token pairs remembered by a worker; when full they start afresh.
MEMORY_ENTRIES = 500_000

#: Characters whose NFC form is themselves, that lower-case one by one, and on whose
#: classes Unicode versions agree. Other chunks go through the library's normaliser.
_PLAIN = re.compile("[!-~¡-įı-ɏ‘’“”–—…]*")
#: str.split() also splits at these, which the vocabulary's pattern takes as text.
_NOT_SPACE = re.compile("[\x1c-\x1f]")


#: Characters of a text that are normalised together: white space, or a letter with its marks.
_CLUSTERS = regex.compile("[^\\S\x1c-\x1f]+|\\X", regex.DOTALL)
#: Chunks and words up to this many characters are remembered.
_REMEMBERED = 64


class PrefixTokenCounter:
    """Prefix counts for a ``tokenizers`` BPE file with an end-of-word suffix."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not end:
            raise ValueError("a BPE vocabulary with an end-of-word suffix is expected")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens are expected to match as they stand")
        specials = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self._special = re.compile("(" + "|".join(specials) + ")") if specials else None
        self._pre_token = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._byte_chars = _byte_characters()

        ids = model["vocab"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self._rank = {(ids[x], ids[y]): k for k, (x, y) in enumerate(merges)}
        made = {ids[x + y]: (ids[x], ids[y], k) for k, (x, y) in enumerate(merges)}
        #: For each token, the tokens at its left and its right edge while it is
        #: merged, each with the rank of the merge that takes it up.
        self._left_edge = {t: self._edge(t, made, 0) for t in ids.values()}
        self._right_edge = {t: self._edge(t, made, 1) for t in ids.values()}
        both: dict[str, list[int]] = {}
        for token, number in ids.items():
            ended = token.endswith(end) and len(token) > len(end)
            both.setdefault(token.removesuffix(end) if ended else token, [-1, -1])[ended] = number
        #: Tokens by their characters: within a word, and at its end.
        self._automaton = ahocorasick.Automaton()
        for shown, (inside, at_end) in both.items():
            self._automaton.add_word(shown, (len(shown), inside, at_end))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._words: dict[str, Sequence[int]] = {}
        self._chunks: dict[str, Sequence[int]] = {}
        self._normal = lru_cache(maxsize=50_000)(self._library.normalizer.normalize_str)

    @staticmethod
    def _edge(token: int, made: dict, side: int) -> list[tuple[int, float]]:
        edge, taken = [(token, float("inf"))], made.get(token)
        while taken:
            edge.append((taken[side], taken[2]))
            taken = made.get(taken[side])
        return edge

    def _compatible(self, pair: int) -> bool:
        """Whether no merge ever crosses from a token into the next, ``pair`` being both.

        A crossing merge comes first if its rank is below that of the merge that
        takes up its left part, and at most that of the one that takes up its
        right part: of equal ranks the leftmost goes first.
        """
        if len(self._pairs) >= MEMORY_ENTRIES:
            self._pairs.clear()
        good = self._pairs[pair] = not self._crossed(pair >> 20, pair & (1 << 20) - 1)
        return good

    def _crossed(self, left: int, right: int) -> bool:
        ranks = self._rank
        for x, x_taken in self._right_edge[left]:
            for y, y_taken in self._left_edge[right]:
                rank = ranks.get((x, y))
                if rank is not None and rank < x_taken and rank <= y_taken:
                    return True
        return False

    def word_prefixes(self, word: str) -> list[int]:
        """Tokens of each prefix of a pre-token in byte characters, taken as a pre-token
        itself: one pass over the tokens that end at each place."""
        size = len(word)
        last, inside, ended = [-1] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        pairs, compatible = self._pairs.get, self._compatible
        done = -1
        for place, (length, token, token_at_end) in self._automaton.iter(word):
            if place == done:
                continue
            end = place + 1
            if length == end:
                if token >= 0:
                    last[end], inside[end] = token, 1
                if token_at_end >= 0:
                    ended[end] = 1
            else:
                start = end - length
                before = last[start] << 20
                if token >= 0 and not inside[end]:
                    good = pairs(before | token)
                    if good or good is None and compatible(before | token):
                        last[end], inside[end] = token, inside[start] + 1
                if token_at_end >= 0 and not ended[end]:
                    good = pairs(before | token_at_end)
                    if good or good is None and compatible(before | token_at_end):
                        ended[end] = inside[start] + 1
            if inside[end] and ended[end]:
                done = place
        if not all(ended[1:]):
            raise ValueError(f"the vocabulary can't encode {word!r}")
        return ended[1:]

    def _pre_token_counts(self, word: str) -> Sequence[int]:
        """Tokens at each character of a normalised pre-token."""
        known = self._words.get(word)
        if known is None:
            if word.isascii() and word.isprintable():
                known = _packed(self.word_prefixes(word))
            else:
                sizes = [len(c.encode()) for c in word]
                counts = self.word_prefixes("".join(map(self._byte_chars.__getitem__, word.encode())))
                known = _packed([counts[at - 1] for at in accumulate(sizes)])
            if word[0] == "'" and len(word) == 3:  # the first two of 're are a mark and a letter
                known = _packed([known[0], sum(self._pre_token_counts(w)[-1] for w in self._pre_token.findall(word[:2])), known[2]])
            if len(word) <= _REMEMBERED:
                if len(self._words) >= MEMORY_ENTRIES:
                    self._words.clear()
                self._words[word] = known
        return known

    def _encoded(self, piece: str) -> int:
        """The library's own count of a piece, added tokens taken as text."""
        normal = self._library.normalizer.normalize_str(piece)
        return sum(self.word_prefixes(w)[-1] for w, _ in self._library.pre_tokenizer.pre_tokenize_str(normal))

    def _along(self, normal: str, spans: list[tuple[int, int]]) -> list[int]:
        """Tokens at each character of a normalised piece with its pre-tokens' places."""
        out: list[int] = []
        base = 0
        for start, end in spans:
            out.extend([base] * (start - len(out)))
            counts = self._pre_token_counts(normal[start:end])
            out.extend([base + c for c in counts] if base else counts)
            base += counts[-1]
        out.extend([base] * (len(normal) - len(out)))
        return out

    def _piece_prefixes(self, piece: str) -> list[int]:
        """Tokens at each character of a piece without added tokens."""
        if _PLAIN.fullmatch(piece):
            normal = piece.lower()
            return self._along(normal, [m.span() for m in self._pre_token.finditer(normal)])
        clusters = _CLUSTERS.findall(piece)
        parts = [self._normal(c) for c in clusters]
        normal = "".join(parts)
        if normal != self._library.normalizer.normalize_str(piece):
            return [self._encoded(piece[:n]) for n in range(1, len(piece) + 1)]
        along = self._along(normal, [span for _, span in self._library.pre_tokenizer.pre_tokenize_str(normal)])
        out: list[int] = []
        at = 0
        for cluster, part in zip(clusters, parts):
            if len(cluster) > 1:
                begun = len(out)
                blank = part == " "
                out.extend(along[at - 1] if at and blank else 0 if blank else self._encoded(piece[: begun + n]) for n in range(1, len(cluster)))
            at += len(part)
            out.append(along[at - 1] if at else 0)
        return out

    def chunk_prefixes(self, chunk: str) -> Sequence[int]:
        """Tokens at each character of a chunk."""
        known = self._chunks.get(chunk)
        if known is not None:
            return known
        if chunk.isascii():
            if chunk.isalpha():  # one pre-token
                return self._remember(chunk, self._pre_token_counts(chunk.lower()))
            if chunk[:-1].isalpha() and chunk.isprintable():  # one and a mark or digit
                word = self._pre_token_counts(chunk[:-1].lower())
                return self._remember(chunk, _packed([*word, word[-1] + self._pre_token_counts(chunk[-1])[-1]]))
        out: list[int] = []
        base = at = 0
        for m in self._special.finditer(chunk) if self._special and "<" in chunk else ():
            before = chunk[at : m.start()]
            own = self._piece_prefixes(before) if before else []
            # Cut short, an added token is text like that before it.
            short = self._piece_prefixes(before + m[0])[len(before) : -1]
            out.extend([base + c for c in [*own, *short]])
            base += (own[-1] if own else 0) + 1
            out.append(base)
            at = m.end()
        if at < len(chunk):
            rest = self._piece_prefixes(chunk[at:])
            out.extend([base + c for c in rest] if base else rest)
        return self._remember(chunk, _packed(out))

    def _remember(self, chunk: str, counts: Sequence[int]) -> Sequence[int]:
        if len(chunk) <= _REMEMBERED:
            if len(self._chunks) >= MEMORY_ENTRIES:
                self._chunks.clear()
            self._chunks[chunk] = counts
        return counts

    def chunks_of(self, text: str) -> tuple[list[str], list[Sequence[int]]]:
        """The text's white-space delimited chunks and the tokens at each of their characters."""
        chunks = [text] if _NOT_SPACE.search(text) else text.split()
        prefixes = list(map(self._chunks.get, chunks))
        if None in prefixes:
            for k, known in enumerate(prefixes):
                if known is None:
                    prefixes[k] = self.chunk_prefixes(chunks[k])
        return chunks, prefixes

    def index(self, text: str) -> PrefixIndex:
        return PrefixIndex(text, *self.chunks_of(text))


def _packed(counts: list[int]) -> Sequence[int]:
    try:
        return bytes(counts)
    except ValueError:  # 256 tokens or more
        return array("i", counts)


class PrefixIndex:
    """Stored counts of all prefixes of one text, for truncation and budget questions."""

    def __init__(self, text: str, chunks: list[str], prefixes: list[Sequence[int]]):
        self._text, self._chunks, self._prefixes = text, chunks, prefixes
        self._sums = [0, *accumulate(p[-1] for p in prefixes)]

    @cached_property
    def _places(self) -> tuple[list[int], list[int]]:
        at, starts, ends = 0, [], []
        for chunk in self._chunks:
            starts.append(self._text.index(chunk, at))
            at = starts[-1] + len(chunk)
            ends.append(at)
        return starts, ends

    def count(self, n_chars: int | None = None) -> int:
        """Tokens of the text's first ``n_chars`` characters."""
        if n_chars is None or n_chars >= len(self._text):
            return self._sums[-1]
        starts, ends = self._places
        whole = bisect_right(ends, n_chars)
        inside = n_chars - starts[whole] if whole < len(starts) else 0
        return self._sums[whole] + (self._prefixes[whole][inside - 1] if inside > 0 else 0)

    def fitting(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        whole = bisect_right(self._sums, budget) - 1
        if whole < 0:
            return 0
        if whole >= len(self._chunks):
            return len(self._text)
        # A longer prefix of a chunk may have fewer tokens than a shorter one.
        rest, counts = budget - self._sums[whole], self._prefixes[whole]
        return self._places[0][whole] + next((n for n in range(len(counts), 0, -1) if counts[n - 1] <= rest), 0)

    def truncate(self, budget: int) -> str:
        return self._text[: self.fitting(budget)]

    def counts(self) -> array:
        """Tokens of each prefix, by its number of characters less one."""
        out = array("i")
        base = 0
        for start, prefixes in zip(self._places[0], self._prefixes):
            out.extend([base] * (start - len(out)))
            out.extend([base + c for c in prefixes])
            base += prefixes[-1]
        out.extend([base] * (len(self._text) - len(out)))
        return out


def _byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def counter_for(path: str) -> PrefixTokenCounter:
    return PrefixTokenCounter(path)


def prefix_token_counts(df: DataFrame, path: str, text: str = "text", budget: int | None = None, keep_prefixes: bool = True) -> DataFrame:
    """Add n_bytes, n_tokens; with ``budget`` fitting_chars, the characters of the longest
    prefix of at most that many tokens; with ``keep_prefixes`` prefix_tokens, the tokens
    of each prefix by its number of characters less one.

    ``path`` must name the vocabulary on every worker.
    """
    prepare_workers(df.sparkSession)
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    if budget is not None:
        added.append(T.StructField("fitting_chars", T.LongType()))
    if keep_prefixes:
        added.append(T.StructField("prefix_tokens", T.ArrayType(T.IntegerType())))
    names = {f.name.lower() for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias(reserved(df, "text")["text"]))
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(width).to_pylist()]
            stored = [counter.index(t) for t in texts]
            columns = [batch.column(k) for k in range(width)]
            columns.append(pa.array([len(t.encode()) for t in texts], pa.int64()))
            columns.append(pa.array([s.count() for s in stored], pa.int64()))
            if budget is not None:
                columns.append(pa.array([s.fitting(budget) for s in stored], pa.int64()))
            if keep_prefixes:
                columns.append(pa.array([s.counts() for s in stored], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + [f.name for f in added])

    return source.mapInArrow(run, T.StructType([*kept, *added]))


def tokens_within(prefix_tokens: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` characters, from stored counts."""
    return F.when(n_chars <= 0, 0).otherwise(F.get(prefix_tokens, F.least(n_chars, F.size(prefix_tokens)) - 1))


def chars_within(prefix_tokens: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from stored counts."""
    return F.coalesce(F.array_max(F.transform(prefix_tokens, lambda c, i: F.when(c <= budget, i + 1))), F.lit(0))


#: Tokens that a context of the intended model holds.
TOKEN_LIMIT = 2048


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = prefix_token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), budget=TOKEN_LIMIT, keep_prefixes=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fitting_chars")
