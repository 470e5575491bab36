"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is cut before every run of spaces; each cut is encoded alone by an agenda of adjacent symbol pairs in
score order (no vocabulary piece holds a space after another character, which is checked when the vocabulary is
read, so no merge crosses a cut). Every cut that is new in an Arrow batch is checked against the sentencepiece
library before it is used; workers keep what they have encoded, up to a bound on memory.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Kept, chunks, gathered, resident

SPACE = "▁"
CACHE_BYTES, CHUNK = 48 << 20, 2 << 20
#: Cuts whose agendas are worked on at once.
TOGETHER = 1 << 15
#: Texts that are not words with one space between each: cut one by one.
ODD = "^$|  |^ | $"
LONG, NONE = 48, 1 << 30


class Pieces:
    """A merge-type vocabulary with its encoder."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.ids = {x: i for i, x in enumerate(names) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.rank = {x: (-sp.get_score(i), i) for x, i in self.ids.items()}
        self.bytes = {int(x[3:5], 16): i for i, x in enumerate(names) if sp.is_byte(i)}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        if any(re.search(f"[^{SPACE}]{SPACE}", x) for x in self.ids):
            raise ValueError("a piece holds a space after another character: cuts can't be encoded alone")
        probe = "  a\tb  Ａ  é "
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the vocabulary normalises more than spaces")
        #: cut -> its ids as 32-bit bytes
        self.cache = Kept(CACHE_BYTES)
        self.decimals = list(map(str, range(sp.get_piece_size())))
        self._index_pairs()

    def _index_pairs(self) -> None:
        """Numbers for symbols (pieces, then characters as they turn up) and the sorted table of pairs that merge."""
        single = sorted({c for x in self.ids for c in x} - self.ids.keys())
        names = [*self.ids, *single]
        number = {x: i for i, x in enumerate(names)}
        self.of_char = np.full(0x110000, -1, np.int32)
        for x, i in number.items():
            if len(x) == 1:
                self.of_char[ord(x)] = i
        spelled = [[self.ids[x]] for x in self.ids] + [self._spelled(x) for x in single]
        self.spelled, self.symbols = spelled, len(names)
        order = {s: r for r, s in enumerate(sorted({score for score, _ in self.rank.values()}))}
        pairs = sorted((number[x[:k]] << 32 | number[x[k:]], order[self.rank[x][0]], i) for i, x in enumerate(self.ids) for k in range(1, len(x)) if x[:k] in number and x[k:] in number)
        self.pair_key = np.array([p[0] for p in pairs] + [1 << 62], np.int64)
        self.pair_rank = np.array([p[1] for p in pairs] + [NONE], np.int32)
        self.pair_made = np.array([p[2] for p in pairs] + [-1], np.int32)

    def _spelled(self, symbol: str) -> list[int]:
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.unknown]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, at, len(self.pair_key) - 1)

    def agendas(self, cuts: list[str]) -> list[np.ndarray]:
        """``agenda`` for many cuts at once: the agendas of all cuts of one length are the rows of a matrix, and
        each round takes the best-scored pair of every row, the leftmost of equals."""
        out: list[np.ndarray] = [None] * len(cuts)
        by_length: dict[int, list[int]] = {}
        for i, x in enumerate(cuts):
            by_length.setdefault(len(x), []).append(i)
        for length, rows in by_length.items():
            if length > LONG or not self.bytes:
                for i in rows:
                    out[i] = self.agenda(cuts[i])
                continue
            points = np.frombuffer("".join(cuts[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32)
            for c in np.unique(points[self.of_char[points] < 0]):
                self.of_char[c] = self.symbols
                self.symbols += 1
                self.spelled.append(self._spelled(chr(c)))
            grid = self.of_char[points].reshape(len(rows), length)
            found = self._pairs(grid[:, :-1], grid[:, 1:])
            rows_at = np.array(rows)
            while len(grid):
                ranks = self.pair_rank[found] if found.shape[1] else np.full((len(grid), 1), NONE, np.int32)
                best = ranks.argmin(1)
                live = ranks[np.arange(len(grid)), best] < NONE
                if not live.all():
                    for i, symbols in zip(rows_at[~live], grid[~live], strict=True):
                        out[i] = symbols
                    grid, found, best, rows_at = grid[live], found[live], best[live], rows_at[live]
                    if not len(grid):
                        break
                each = np.arange(len(grid))
                made = self.pair_made[found[each, best]]
                # Every live row loses one symbol a round, so the rows keep one length.
                columns = np.arange(grid.shape[1] - 1)
                grid = np.take_along_axis(grid, columns + (columns > best[:, None]), 1)
                grid[each, best] = made
                columns = np.arange(found.shape[1] - 1)
                found = np.take_along_axis(found, columns + (columns >= best[:, None]), 1)
                has = np.flatnonzero(best < grid.shape[1] - 1)
                found[has, best[has]] = self._pairs(grid[has, best[has]], grid[has, best[has] + 1])
                has = np.flatnonzero(best > 0)
                found[has, best[has] - 1] = self._pairs(grid[has, best[has] - 1], grid[has, best[has]])
            for i in rows:
                out[i] = list(chain.from_iterable(map(self.spelled.__getitem__, out[i].tolist())))
        return out

    def agenda(self, cut: str) -> list[int]:
        """Ids of one cut: the best-scored adjacent pair merges first, the leftmost of equals."""
        rank, ids = self.rank, self.ids
        if cut in ids and len(cut) == 1:
            return [ids[cut]]
        symbols = list(cut)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(rank[p][0], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in rank]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = after[i]
            # Both halves must still stand as they did: a merge lengthens its left symbol and blanks its right one.
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != len(pair):
                continue
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := pair + symbols[k]) in rank:
                    heapq.heappush(agenda, (rank[p][0], i, p))
            h = before[i]
            if h >= 0 and (p := symbols[h] + pair) in rank:
                heapq.heappush(agenda, (rank[p][0], h, p))
        out, unknown = [], False
        for s in symbols:
            if not s:
                continue
            if s in ids:
                out.append(ids[s])
                unknown = False
            elif self.bytes:
                out += map(self.bytes.__getitem__, s.encode())
            elif not unknown:  # a run of unknown symbols is one unknown id
                out.append(self.unknown)
                unknown = True
        return out

    def cuts(self, text: str) -> list[str]:
        """Runs of spaces with what follows them; the vocabulary's own space comes first and counts as one."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        found = re.findall(" +[^ ]*", " " + text)
        return [x[1:] for x in found]

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the whole texts in turn, each with the end id; number of ids of each)."""
        texts = pc.replace_substring(texts, SPACE, " ")
        odd = pc.match_substring_regex(texts, ODD)
        plain, n_plain = self._of_cuts(pc.split_pattern(texts.filter(pc.invert(odd)), " "))
        cut = [self.cuts(x) for x in texts.filter(odd).to_pylist()]
        rest, n_rest = self._of_cuts(pa.array(cut, pa.large_list(pa.large_string())))
        odd = odd.to_numpy(zero_copy_only=False)
        n = np.empty(len(texts), np.int64)
        n[~odd], n[odd] = n_plain, n_rest
        ids = np.empty(n.sum(), np.int32)
        of_odd = np.repeat(odd, n)
        ids[~of_odd], ids[of_odd] = plain, rest
        return ids, n

    def _of_cuts(self, split: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(split):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        at = np.asarray(split.offsets).astype(np.int64)
        at -= at[0]
        cuts = pc.dictionary_encode(split.flatten())
        known = self._known(cuts.dictionary.to_pylist())
        codes = np.insert(np.array(cuts.indices), at[1:], len(known))
        ids, n = gathered(codes, [*known, np.array([self.end], np.int32).tobytes()])
        return ids.view(np.int32), np.add.reduceat(n, at[:-1] + np.arange(len(split)), dtype=np.int64)

    def _known(self, cuts: list[str]) -> list[bytes]:
        """The ids of each cut; new ones are encoded and checked against the library."""
        found = self.cache.get(cuts)
        if None not in found:
            return found
        new = [cut for cut, x in zip(cuts, found, strict=True) if x is None]
        learnt: dict[str, bytes] = {}
        for k in range(0, len(new), TOGETHER):
            some = new[k : k + TOGETHER]
            for cut, own, right in zip(some, self.agendas([SPACE + x.replace(" ", SPACE) for x in some]), self.library.encode(some, num_threads=1), strict=True):
                if own != right and cut:  # a lone space at a text's end: the library can't be given one by itself
                    raise AssertionError(f"the agenda gives {own} for {cut!r}, the library {right}")
                learnt[cut] = array("i", own).tobytes()
        self.cache.add(learnt)
        return [learnt[cut] if x is None else x for cut, x in zip(cuts, found, strict=True)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not texts:
            return []
        ids, n = self.encoded(pa.array(texts, pa.large_string()))
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


def loaded(path: str) -> Pieces:
    return resident("pieces", path, lambda: Pieces(path))


def _codec(path: str, digests: bool, carried: list[str]):
    def run(batches):
        pieces = loaded(path)
        for batch in batches:
            for row, texts in chunks(batch.column("text"), CHUNK):
                ids, n = pieces.encoded(texts)
                ends = np.cumsum(n)
                head = [*(batch.column(c).slice(row, len(texts)) for c in carried), pa.array(n, pa.int64())]
                sums, decoded = [], []
                for begin, end in zip((ends - n).tolist(), ends.tolist(), strict=True):
                    own = ids[begin:end].tolist()
                    back = pieces.library.decode(own)
                    if digests:
                        sums.append(hashlib.sha256(" ".join(map(pieces.decimals.__getitem__, own)).encode()).hexdigest())
                        back = hashlib.sha256(back.encode()).hexdigest()
                    decoded.append(back)
                if digests:
                    yield pa.RecordBatch.from_arrays([*head, pa.array(sums, pa.string()), pa.array(decoded, pa.string())], [*carried, "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([*head, lists, pa.array(decoded, pa.string())], [*carried, "n_tokens", "ids", "decoded"])

    return run


def piece_codec(docs: DataFrame, model_path: str, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per input row: the ``carry`` columns, ``n_tokens``, ``ids`` with the end id, ``decoded`` text.

    With ``digests`` the last two are ``ids_sha256`` and ``decoded_sha256``, made where the ids are, so that ids
    do not cross to the JVM. A null or empty text has the end id only and decodes to "". Repeated rows are
    encoded each; ids of documents are only carried and may be null or tied; columns not named in ``carry`` are
    left out. Long texts are encoded whole. An empty table gives an empty table. There is no shuffle.
    """
    names = [f"carry{i}" for i in range(len(carry))]
    kinds = [f"{a} {docs.schema[c].dataType.simpleString()}" for c, a in zip(carry, names, strict=True)]
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    rows = docs.select(*(F.col(c).alias(a) for c, a in zip(carry, names, strict=True)), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_codec(model_path, digests, names), ", ".join([*kinds, "n_tokens long", rest]))
    return out.select(*(F.col(a).alias(c) for c, a in zip(carry, names, strict=True)), *out.columns[len(names) :])


def op10_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_codec(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"), digests=True)
