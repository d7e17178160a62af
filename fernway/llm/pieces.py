"""SentencePiece BPE encoding and decoding by vectorised merge rounds."""

from __future__ import annotations

import re
from functools import cache, cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import begin, packed

# Fixed values of the library: its blank symbol, and the piece types.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.iinfo(np.int32).max
CACHED = 300_000
LONG = 64
QUEUED = 4_096


class PieceModel:
    """A BPE model with byte fallback, no normalisation and a blank put before the text.

    Other models are refused, since their rules differ.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kinds = proto.normalizer_spec, [p.type for p in proto.pieces]
        if (
            proto.trainer_spec.model_type != proto.trainer_spec.BPE
            or norm.precompiled_charsmap
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
            or norm.remove_extra_whitespaces
            or set(kinds) != {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError("only BPE models with byte fallback and no normalisation")
        names = [p.piece for p in proto.pieces]
        self.bos, self.eos = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.byte_ids = np.zeros(256, np.uint32)
        self.surface, byte_of = [], {}
        for i, (name, kind) in enumerate(zip(names, kinds)):
            if kind == BYTE:
                byte_of[i] = int(name[3:5], 16)
                self.byte_ids[byte_of[i]] = i
            shown = {CONTROL: "", UNKNOWN: " ⁇ ", BYTE: ""}.get(kind, name.replace(BLANK, " "))
            self.surface.append(bytes([byte_of[i]]) if kind == BYTE else shown.encode())
        self.control = {i for i, kind in enumerate(kinds) if kind == CONTROL}
        normal = {n: i for i, n in enumerate(names) if kinds[i] == NORMAL}
        # Symbols are pieces, then characters that only occur inside pieces.
        symbols = dict(normal)
        for c in sorted({c for n in normal for c in n} - normal.keys()):
            symbols[c] = len(names) + len(symbols)
        self.n_pieces, self.n_symbols = len(names), 2 * len(names) + len(symbols)
        self.char_symbol = np.full(0x110000, -1, np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = i
        # Rank of a piece: 0 for the best score; equal scores share a rank.
        order = sorted({-proto.pieces[i].score for i in normal.values()})
        rank_of_score = {s: r for r, s in enumerate(order)}
        rank = {i: rank_of_score[-proto.pieces[i].score] for i in normal.values()}
        pairs = {}
        for name, i in normal.items():
            for cut in range(1, len(name)):
                left, right = symbols.get(name[:cut]), symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * self.n_symbols + right] = i
        keys = np.array(sorted(pairs), np.int64)
        self.keys, self.merged = keys, np.array([pairs[k] for k in keys.tolist()], np.int64)
        self.rank = np.array([rank[i] for i in self.merged.tolist()], np.int32)
        # A merge into one of these can make a pair that is as good or better, so occurrences
        # can't be merged all at once.
        lefts, rights = keys // self.n_symbols, keys % self.n_symbols
        self.alone = np.zeros(self.n_symbols, bool)
        for part in (lefts, rights):
            own = np.array([rank.get(i, -1) for i in part.tolist()], np.int64)
            self.alone[part[(own >= 0) & (self.rank <= own)]] = True
        # Blanks before a word form words of their own where no piece crosses and blank-only
        # pieces are the last to be made, from the left.
        if any(BLANK in n.lstrip(BLANK) for n in normal):
            raise ValueError("pieces with an inner blank")
        blanks = {len(n): rank[i] for n, i in normal.items() if len(n) > 1 and set(n) == {BLANK}}
        most = max(blanks, default=0)
        chain = most > 1 and set(blanks) == set(range(2, most + 1))
        last = set(blanks.values()) == {len(order) - 1}
        long_run = f"{BLANK}{{{most}}}(?={BLANK})|" if chain and last else ""
        self.split = re.compile(f"{long_run}{BLANK}*[^{BLANK}]+|{BLANK}+").findall
        inside = {(a, b) for n in normal for a, b in zip(n, n[1:])}
        self.inside = np.array(sorted(ord(a) << 21 | ord(b) for a, b in inside), np.int64)
        self.cache: dict[str, bytes] = {}

    def segments(self, word: str) -> list[str]:
        """A long word cut between all neighbours that stand side by side in no piece, so no merge can cross a
        cut. A round then merges one pair in every segment, not one in the whole word."""
        if len(word) <= LONG or not len(self.inside):
            return [word]
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        key = chars[:-1] << 21 | chars[1:]
        at = np.minimum(np.searchsorted(self.inside, key), len(self.inside) - 1)
        edges = [0, *(np.flatnonzero(self.inside[at] != key) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(edges, edges[1:])]

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        """Rank and merged symbol of each pair."""
        return dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist())))

    def merge_queued(self, word: str) -> bytes:
        """Ids of one very long segment, which would need about as many rounds as it has characters: pairs wait
        in a heap by rank and place, so the time grows like a sort of them."""
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        found = self.char_symbol[chars]
        sym = np.where(found < 0, -chars - 1, found).tolist()
        before, after = list(range(-1, len(sym) - 1)), [*range(1, len(sym)), -1]

        def pair(i: int):
            j = after[i] if i >= 0 else -1
            if j < 0 or sym[i] < 0 or sym[j] < 0:
                return None
            made = self.merges.get(sym[i] * self.n_symbols + sym[j])
            return made and (made[0], i, sym[i], sym[j], made[1])

        heap = [p for p in map(pair, range(len(sym))) if p]
        heapify(heap)
        gone = NONE
        while heap:
            _, i, left, right, into = heappop(heap)
            j = after[i]
            # A symbol that was merged since makes the entry void.
            if j < 0 or sym[i] != left or sym[j] != right:
                continue
            sym[i], sym[j], after[i] = into, gone, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for p in (pair(before[i]), pair(i)):
                if p:
                    heappush(heap, p)
        left = np.array([s for s in sym if s != gone], np.int64)
        out = [b""]
        self._emit(out, np.array([0]), np.array([len(left)]), left)
        return out[0]

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian bytes.

        All words lie in flat arrays. In a round each word's best-ranked pair is found by a
        segmented minimum, its occurrences are merged from the left, merged symbols are
        compacted, and words without a pair leave.
        """
        out = [b""] * len(words)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        which = np.arange(len(words))
        sym = self.char_symbol[chars]
        # Characters without a symbol merge with nothing; they are kept as negative numbers.
        sym = np.where(sym < 0, -chars - 1, sym)
        while len(which):
            starts = np.cumsum(sizes) - sizes
            seg = np.repeat(np.arange(len(which)), sizes)
            rank = np.full(len(sym), NONE, np.int32)
            into = np.full(len(sym), -1, np.int64)
            left = np.flatnonzero((seg[:-1] == seg[1:]) & (sym[:-1] >= 0) & (sym[1:] >= 0))
            if len(left):
                key = sym[left] * self.n_symbols + sym[left + 1]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                rank[left[hit]], into[left[hit]] = self.rank[at[hit]], self.merged[at[hit]]
            best = np.minimum.reduceat(rank, starts)
            done = best == NONE
            if done.any():
                self._emit(out, which[done], sizes[done], sym[done[seg]])
                keep = ~done
                live = keep[seg]
                which, sizes, best = which[keep], sizes[keep], best[keep]
                sym, rank, into = sym[live], rank[live], into[live]
                if not len(which):
                    break
                seg = np.repeat(np.arange(len(which)), sizes)
            at = np.flatnonzero(rank == best[seg])
            # Neighbouring occurrences overlap: every other one of a run, from the left.
            fresh = np.ones(len(at), bool)
            fresh[1:] = (at[1:] != at[:-1] + 1) | (seg[at[1:]] != seg[at[:-1]])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            chosen = (np.arange(len(at)) - run) % 2 == 0
            first = np.ones(len(at), bool)
            first[1:] = seg[at[1:]] != seg[at[:-1]]
            risky = np.zeros(len(which), bool)
            risky[seg[at[self.alone[into[at]]]]] = True
            chosen &= ~risky[seg[at]] | first
            at = at[chosen]
            sym[at] = into[at]
            sizes = sizes - np.bincount(seg[at], minlength=len(which))
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym = sym[stay]
        return out

    def _emit(self, out, which, sizes, sym) -> None:
        """Store finished words; what isn't a piece becomes the bytes of its character."""
        known = (sym >= 0) & (sym < self.n_pieces)
        if known.all():
            flat = sym.astype("<u4").tobytes()
            ends = np.cumsum(sizes) * 4
            for w, a, b in zip(which.tolist(), (ends - sizes * 4).tolist(), ends.tolist()):
                out[w] = flat[a:b]
            return
        starts = np.cumsum(sizes) - sizes
        for w, a, n in zip(which.tolist(), starts.tolist(), sizes.tolist()):
            parts = []
            for s in sym[a : a + n].tolist():
                if 0 <= s < self.n_pieces:
                    parts.append(s)
                else:
                    char = self.lone_char(s)
                    parts.extend(self.byte_ids[list(char.encode())].tolist())
            out[w] = np.array(parts, "<u4").tobytes()

    def lone_char(self, symbol: int) -> str:
        return chr(-symbol - 1) if symbol < 0 else chr(int(np.flatnonzero(self.char_symbol == symbol)[0]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts with begin and end, as little-endian unsigned 32-bit numbers."""
        split = [self.split(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        split = [[s for w in parts for s in self.segments(w)] for parts in split]
        known = self.cache
        if len(known) > CACHED:
            known.clear()
        new = list({w for parts in split for w in parts if w not in known})
        known.update((w, self.merge_queued(w)) for w in new if len(w) > QUEUED)
        new = [w for w in new if len(w) <= QUEUED]
        known.update(zip(new, self.merge_words(new)))
        begin_, end = np.array([[self.bos], [self.eos]], "<u4")
        return [begin_.tobytes() + b"".join([known[w] for w in p]) + end.tobytes() for p in split]

    def decode(self, ids: bytes) -> str:
        """Text of the ids, without the blank before the first piece."""
        parts = np.frombuffer(ids, "<u4").tolist()
        first = next((i for i in parts if i not in self.control), None)
        text = b"".join([self.surface[i] for i in parts]).decode("utf-8", "replace")
        starts_blank = first is not None and self.surface[first].startswith(b" ")
        return text[1:] if starts_blank and first not in self.byte_ids else text


@cache
def load_model(path: str) -> PieceModel:
    """One model per Python process."""
    return PieceModel(path)


def encode_pieces(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Ids of every whole text with begin and end ids, and the text decoded from them.

    Returns ``doc`` (the input row), ``ids`` (binary, little-endian unsigned 32-bit) and
    ``decoded``. ``model_path`` is a file that every executor has. Null and empty texts have
    the two ids only. No shuffle; a batch's new words are merged together.
    """
    begin(docs.sparkSession)

    @F.pandas_udf("ids binary, decoded string")
    def encode(texts: pd.Series) -> pd.DataFrame:
        model = load_model(model_path)
        ids = model.encode(texts.fillna("").tolist())
        return pd.DataFrame({"ids": ids, "decoded": [model.decode(i) for i in ids]})

    return (
        packed(docs)
        .withColumn("_got", encode(F.col(f"doc.{text}")))
        .select("doc", "_got.ids", "_got.decoded")
    )

