"""Encoding and decoding with a SentencePiece BPE model through a table of prefixes.

For a string, the encoding of each prefix ends in exactly one token. The table stores that token for each prefix: an
Aho-Corasick automaton of the vocabulary gives the tokens that end at a position, and the one to store is that whose
predecessor, the stored token of the prefix before it, is compatible with it, which means that merging the two tokens' text alone
gives the two back. Ids are then recovered backwards from the last position.

A space starts every token it is part of, but for runs of spaces, so no merge crosses from another character to a space.
Texts are cut there, and tables are built once for each distinct cut and kept in a cache of bounded size.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import cached_property, lru_cache
from operator import itemgetter

import ahocorasick
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

SPACE = "▁"
#: Distinct cuts, and pairs of tokens, that a worker remembers.
CACHE_CUTS, CACHE_PAIRS = 300_000, 1_000_000


class PrefixTable:
    """Encoder and decoder for the model file at `path`: identity normaliser, dummy prefix, escaped spaces, byte fallback."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(self.size)]
        self.byte_id = {int(pieces[i][3:-1], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.id_byte = {i: b for b, i in self.byte_id.items()}
        self.silent = {i for i in range(self.size) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.piece = pieces
        self.shown = ["" if i in self.silent else p.replace(SPACE, " ") for i, p in enumerate(pieces)]
        self.score = {pieces[i]: sp.get_score(i) for i in range(self.size) if plain[i]}
        self.ids = {pieces[i]: i for i in range(self.size) if plain[i]}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a token has a space after another character; texts can't be cut at spaces")
        #: Order of merging: equal scores are equal.
        order = {v: k for k, v in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = {p: order[v] for p, v in self.score.items()}
        self.halves: dict[str, tuple[str, str]] = {}
        self.letters = set().union(*self.ids)
        self._pairs: dict[int, bool] = {}
        self._single: dict[str, int] = {}
        self._back: list[str] = []

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for p, i in self.ids.items():
            steps: list[tuple[str, str]] = []
            if len(p) == 1 or self.merge(p, steps) == [p]:  # others never come out of merging
                found.add_word(p, (len(p), i))
                self.halves[p] = steps[-1] if steps else (p, p)
        found.make_automaton()
        return found

    def merge(self, text: str, steps: list | None = None) -> list[str]:
        """BPE by its definition: the best scored neighbours first, the leftmost of equals. steps: gets the pairs merged."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts):
                s = self.score.get(whole := parts[a] + parts[b])
                if s is not None:
                    heapq.heappush(heap, (-s, a, b, whole))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, whole = heapq.heappop(heap)
            if parts[a] is None or b >= len(parts) or parts[b] is None or after[a] != b or parts[a] + parts[b] != whole:
                continue
            if steps is not None:
                steps.append((parts[a], parts[b]))
            parts[a], parts[b] = whole, None
            after[a] = after[b]
            if after[a] < len(parts):
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in parts if p is not None]

    def _text(self, token: int) -> str:
        return self.piece[token] if token < self.size else self._back[token - self.size]

    def _compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._stay_apart(self._text(a), self._text(b))
        return known

    def _stay_apart(self, x: str, y: str) -> bool:
        """Whether merging x + y gives x and y, by undoing merges next to the border, the latest first.

        x and y are at each moment the parts on both sides of the border. They would have merged had their union been due
        before the merge that was undone last. Of equal merges the left one is earlier.
        """
        if x[-1] == SPACE == y[-1]:  # runs of spaces have equal scores
            return self.merge(x + y) == [x, y]
        rank, halves = self.rank, self.halves
        due = rank.get(x + y)
        if due is not None:
            return False
        while True:
            last_x = rank[x] if len(x) > 1 else -1
            last_y = rank[y] if len(y) > 1 else -1
            if last_x < 0 and last_y < 0:
                return True
            if last_x > last_y:
                x = halves[x][1]
                due = rank.get(x + y)
                if due is not None and due < last_x:
                    return False
            else:
                y = halves[y][0]
                due = rank.get(x + y)
                if due is not None and due <= last_y:
                    return False

    def _foreign(self, char: str) -> int:
        """A number past the vocabulary for a single character that isn't a piece."""
        i = self._single.get(char)
        if i is None:
            i = self._single[char] = self.size + len(self._back)
            self._back.append(char)
        return i

    def tokens(self, cut: str) -> list[int]:
        """Ids of one cut of normalised text."""
        n = len(cut)
        last = [-1] * n  # the last token of each prefix
        pairs = self._pairs
        for end, (size, token) in self.automaton.iter(cut):
            if last[end] < 0:
                start = end - size
                if start < 0:
                    last[end] = token
                    continue
                # a prefix with no token yet ends in a character that is no piece
                before = last[start] if last[start] >= 0 else self._stored(last, cut, start)
                known = pairs.get(before << 32 | token)
                if known or known is None and self._compatible(before, token):
                    last[end] = token
        out: list[int] = []
        i = n - 1
        while i >= 0:
            token = self._stored(last, cut, i)
            if token < self.size:
                out.append(token)
                i -= len(self.piece[token])
            else:
                out.extend(self.byte_id[b] for b in reversed(cut[i].encode()))
                i -= 1
        out.reverse()
        return out

    def _stored(self, last: list[int], cut: str, i: int) -> int:
        token = last[i]
        if token < 0:
            token = last[i] = self._foreign(cut[i])
        return token

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces in order, byte runs as UTF-8, spaces restored, the dummy prefix taken off."""
        return self.spell(ids).removeprefix(" ")

    def spell(self, ids: list[int]) -> str:
        if self.id_byte.keys().isdisjoint(ids) and self.unknown not in ids:
            return "".join([self.shown[i] for i in ids])
        out, run = [], bytearray()
        for i in ids:
            if i in self.id_byte:
                run.append(self.id_byte[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.piece[i].replace(SPACE, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)


class Cuts(dict):
    """word -> (decimal ids of prefix + word, comma-joined; their text). Two generations: at the bound the older half is let go."""

    def __init__(self, coder: Coder, prefix: str):
        super().__init__()
        self.coder, self.prefix, self.old = coder, prefix, {}

    def __missing__(self, word: str) -> tuple[str, str]:
        if len(self) >= CACHE_CUTS // 2:
            self.old = dict(self)
            self.clear()
        out = self.old.get(word)
        if out is None:
            ids = self.coder.ids(self.prefix + word)
            out = (",".join(map(str, ids)), self.coder.table.spell(ids))
        self[word] = out
        return out


class Coder:
    """Encodes texts cut at spaces and line ends; cuts that recur are taken from the caches."""

    _split = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    _first, _second = itemgetter(0), itemgetter(1)

    def __init__(self, table: PrefixTable):
        self.table = table
        self.spaced, self.bare = Cuts(self, SPACE), Cuts(self, "")
        foreign = "".join(c for c in map(chr, range(32)) if c not in table.letters)
        self.foreign = regex.compile("([" + "".join(f"\\x{ord(c):02x}" for c in foreign) + "])") if foreign else None
        self.line_end = None if "\n" in table.letters else ",".join(map(str, table.tokens("\n")))

    def ids(self, normal: str) -> list[int]:
        """Ids of normalised text: cut at spaces, and around control characters that no piece holds."""
        if SPACE not in normal[1:] and not (self.foreign and self.foreign.search(normal)):
            return self.table.tokens(normal) if normal else []
        out: list[int] = []
        for cut in self._split.findall(normal):
            for part in self.foreign.split(cut) if self.foreign else [cut]:
                if part:
                    out += self.table.tokens(part)
        return out

    def encode(self, text: str) -> tuple[str, str]:
        """(decimal ids joined by commas, decoded text) of a whole text."""
        if not text:
            return "", ""
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text or self.line_end is None or " \n" in text:
            ids = self.ids(SPACE + text.replace(" ", SPACE))
            return ",".join(map(str, ids)), self.table.decode(ids)
        found: list[tuple[str, str]] = []
        spaced, bare, end = self.spaced.__getitem__, self.bare.__getitem__, (self.line_end, "\n")
        head = spaced  # the first word has the dummy prefix
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            if first or head is spaced:
                found.append(head(first))
            found += map(spaced, rest)
            found.append(end)
            head = bare
        found.pop()
        return ",".join(map(self._first, found)), "".join(map(self._second, found)).removeprefix(" ")


@lru_cache(maxsize=2)
def coder_for(model: str) -> Coder:
    """One for each worker process, which serves many tasks."""
    return Coder(PrefixTable(model))


def encode_decode(docs: DataFrame, model: str, text: str = "text", ids: bool = True) -> DataFrame:
    """docs with n_tokens, token_ids (decimal, comma-joined; with `ids`) and decoded.

    model: path of the model file on every worker. Null text counts as empty and gives no ids. Texts are encoded whole; other columns,
    repeated rows and null ids pass through.
    """
    fields = [T.StructField("n_tokens", T.LongType()), *[T.StructField("token_ids", T.StringType())] * ids, T.StructField("decoded", T.StringType())]
    keep = docs.columns

    def run(batches):
        coder = coder_for(model)
        for batch in batches:
            said, spelled = [], []
            for t in batch.column(text).to_pylist():
                a, b = coder.encode(t or "")
                said.append(a)
                spelled.append(b)
            n = pa.array([a.count(",") + 1 if a else 0 for a in said], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), n, *[pa.array(said, pa.string())] * ids, pa.array(spelled, pa.string())], [*keep, *(f.name for f in fields)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode_decode, reduced where the ids are made."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches):
        coder = coder_for(model)
        for batch in batches:
            rows = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            n = pa.array([a.count(",") + 1 if a else 0 for a, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, pa.array([sha(a) for a, _ in rows], pa.string()), pa.array([sha(b) for _, b in rows], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, T.StructType([T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_sentencepiece(docs: DataFrame) -> DataFrame:
    return digests(docs, model_path())
