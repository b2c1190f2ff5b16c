"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from the model file: the normaliser (a longest-match transducer of the
character map, blank -> U+2581, dummy prefix, optional squeezing of blanks), the piece automaton (a trie whose accepting states
emit a piece) and byte fallback (a character without a piece emits its UTF-8 bytes; without byte
fallback, a run of such characters emits one unknown id). They
are composed with each input on the fly, and the output is the path of least weight in the
tropical semiring (min, +).

* Unigram models: a piece arc weighs minus its score, a fallback arc the unknown penalty. Among paths of equal
  weight up to rounding, the library's choice depends on single-precision sums from the text's start; a
  stretch whose lightest path isn't clear of that rounding is therefore weighed again in such sums.
* BPE models: an arc weighs 0 if the merges would leave its piece and the piece before it
  side by side, infinity otherwise. Merges are ordered by score and then position, so what
  happens inside two neighbouring pieces doesn't depend on the rest of the text; hence the
  paths of finite weight are exactly the result of the merges, there is one, and the state
  after a prefix is its last piece alone.

No piece contains a blank after another character or a line feed beside others, so the
composition is done for the stretches between such points, whose paths are kept in a
bounded cache in each Python worker.
"""

from __future__ import annotations

import ctypes
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import KeyedEncoder, WorkerCache, id_text, slices, text_slices

BLANK = "▁"
#: Fixed values of the model file format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Fixed value: an unknown character's weight is the lowest score less this.
UNKNOWN_PENALTY = 10.0
#: Entries of a worker cache's generation; longer stretches are never kept.
CACHE_ENTRIES, CACHE_CHARS = 1 << 17, 48
PAIR_ENTRIES = 1 << 20
#: Text that a task encodes at once.
TEXT_BYTES = 1 << 20


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, blob[at:at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, struct.unpack("<f" if kind == 5 else "<d", blob[at:at + n])[0]
            at += n


def single(x: float) -> float:
    """``x`` rounded to single precision."""
    return ctypes.c_float(x).value


def character_map(blob: bytes) -> dict[str, str]:
    """The rewrites of a model's compiled character map: a double-array trie and the texts its leaves point to."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, texts = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size:]
    labels = np.arange(1, 256)
    # fixed values of the trie's units: 1 << 31 | 0xFF the label, 1 << 8 a leaf below, 10.. the offset (by 8 bits more if 1 << 9)
    below = lambda u: (u >> 10) << ((u & 512) >> 6)
    out: dict[str, str] = {}
    waiting: list[tuple[np.ndarray, list[bytes]]] = [(below(units[:1]), [b""])]
    while waiting:
        nodes, keys = waiting.pop()
        child = nodes[:, None] ^ labels
        unit = units[np.minimum(child, len(units) - 1)]
        there = (child < len(units)) & (unit & (1 << 31 | 0xFF) == labels)
        unit, at = unit[there], child[there] ^ below(unit[there])
        keys = [keys[k] + bytes((c,)) for k, c in zip(np.nonzero(there)[0].tolist(), np.nonzero(there)[1] + 1)]
        for k in np.flatnonzero(unit & 256).tolist():
            begin = int(units[at[k]] & 0x7FFFFFFF)
            out[keys[k].decode()] = texts[begin:texts.index(b"\0", begin)].decode()
        waiting += [(at[k:k + 1024], keys[k:k + 1024]) for k in range(0, len(at), 1024)]
    return out


class PieceTransducer:
    """The compiled machines of one model; ``encode`` and ``decode`` run them."""

    def __init__(self, pieces: list[tuple[str, float, int]], bpe: bool, byte_fallback: bool,
                 dummy_prefix: bool = True, squeeze: bool = False, rewrites: dict[str, str] | None = None):
        self.pieces, self.bpe = pieces, bpe
        self.byte_fallback, self.dummy_prefix, self.squeeze = byte_fallback, dummy_prefix, squeeze
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        scores = [pieces[i][1] for i in self.ids.values()]
        self.unknown_weight = -single(min(scores, default=0.0) - UNKNOWN_PENALTY)
        self.heaviest = max(map(abs, [self.unknown_weight, *scores]))
        self.rewrites = {k: v for k, v in (rewrites or {}).items() if k != v}
        self.longest: dict[str, int] = {}  # of the rewrites that begin with a character
        for k in self.rewrites:
            self.longest[k[0]] = max(len(k), self.longest.get(k[0], 0))
        self.rewritten = re.compile("[" + "".join(map(re.escape, sorted(self.longest))) + "]") if self.rewrites else None
        self.weight = {p: -pieces[i][1] for p, i in self.ids.items()}
        if any("\n" in p and p != "\n" or BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece crosses words or lines")
        if any(kind == USER_DEFINED for _, _, kind in pieces):
            raise ValueError("user-defined pieces are not supported")
        self.trie: dict = {}
        for p in self.ids:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        self._splits: dict[str, tuple[str, str] | None] = {}
        self._beside = WorkerCache(self._left_alone, PAIR_ENTRIES)
        self.paths = WorkerCache(self.shortest_path if bpe else self._lightest, CACHE_ENTRIES)
        self.width = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.table = KeyedEncoder(self._plain, self._key, lambda t: self._packed(self.normalise(t)), self.width)
        self.out = [self._output(p, kind) for p, _, kind in pieces]

    @classmethod
    def load(cls, path: str) -> PieceTransducer:
        pieces, kind, fallback, suffix, normaliser = [], 1, False, 0, {}
        with open(path, "rb") as f:
            blob = f.read()
        for number, value in _fields(blob):
            if number == 1:
                x = dict(_fields(value))
                pieces.append((x.get(1, b"").decode(), x.get(2, 0.0), x.get(3, NORMAL)))
            elif number == 2:
                x = dict(_fields(value))
                kind, fallback, suffix = x.get(3, 1), bool(x.get(35, 0)), x.get(24, 0)
            elif number == 3:
                normaliser = dict(_fields(value))
        if kind not in (1, 2):
            raise ValueError("only unigram and BPE models are compiled")
        if suffix or normaliser.get(5, 1) != 1:
            raise ValueError("only models with escaped blanks before words are compiled")
        return cls(pieces, kind == 2, fallback, bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)),
                   character_map(normaliser.get(2, b"")))

    # -- normaliser
    def rewrite(self, text: str) -> str:
        """The character map's longest matches, from left to right, replaced; other characters as they are."""
        if self.rewritten is None:
            return text
        out, done = [], 0
        hit = self.rewritten.search(text)
        while hit:
            at = hit.start()
            for n in range(min(self.longest[text[at]], len(text) - at), 0, -1):
                new = self.rewrites.get(text[at:at + n])
                if new is not None:
                    out += text[done:at], new
                    done = at + n
                    break
            hit = self.rewritten.search(text, max(done, at + 1))
        return "".join(out) + text[done:]

    def normalise(self, text: str) -> str:
        if not text:
            return text
        prefix = BLANK if self.dummy_prefix else ""
        text = self.rewrite(text)
        if not self.squeeze:
            return prefix + text.replace(" ", BLANK)
        text = " ".join(x for x in text.split(" ") if x)
        return (prefix + text.replace(" ", BLANK)).rstrip(BLANK) if text else text

    @staticmethod
    def stretches(text: str) -> list[str]:
        """A normalised text cut where no piece can cross: before blanks after another character and around line feeds."""
        out: list[str] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append("\n")
            if BLANK * 2 in line:  # runs of blanks stay together with the word after them
                cuts = [0, *(i for i in range(1, len(line)) if line[i] == BLANK != line[i - 1]), len(line)]
                out += [line[i:j] for i, j in zip(cuts, cuts[1:])]
            elif line:
                first, *rest = line.split(BLANK)
                if first:
                    out.append(first)
                out += map(BLANK.__add__, rest)
        return out

    # -- pieces and byte fallback, composed with a stretch
    def shortest_path(self, stretch: str) -> bytes:
        """Ids of the path of least weight, packed."""
        return np.array(self._ids_of(self._merge_path(stretch) if self.bpe else self._lightest(stretch)[0]), self.width).tobytes()

    def _ids_of(self, path: list[str]) -> list[int]:
        ids: list[int] = []
        for p in path:
            if p in self.ids:
                ids.append(self.ids[p])
            elif self.byte_fallback:
                ids += [self.byte_ids[b] for b in p.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def _merge_path(self, s: str) -> list[str]:
        n = len(s)
        last: list[str | None] = [None] * (n + 1)
        trie, beside = self.trie, self._beside
        for i in range(n):
            before = last[i] if i else ""
            if before is None:
                continue
            node, j = trie, i
            while j < n and (node := node.get(s[j])) is not None:
                j += 1
                if last[j] is None and (piece := node.get("")) is not None and (not i or beside[before, piece]):
                    if i or self._is_whole(piece):
                        last[j] = piece
            if last[i + 1] is None and s[i] not in trie:
                last[i + 1] = s[i]
        return self._trace(last, n)

    def _lightest(self, s: str) -> tuple[list[str], float]:
        """(the path of least weight, by how much at least it beats another at one of its states)."""
        n, inf = len(s), float("inf")
        best, second, last = [0.0] + [inf] * n, [inf] * (n + 1), [None] * (n + 1)

        def arc(i: int, j: int, weight: float, piece: str) -> None:
            if (w := best[i] + weight) < best[j]:
                best[j], second[j], last[j] = w, best[j], piece
            elif w < second[j]:
                second[j] = w

        for i in range(n):
            node, j, alone = self.trie, i, False
            while j < n and (node := node.get(s[j])) is not None:
                j += 1
                if (piece := node.get("")) is not None:
                    alone |= j == i + 1
                    arc(i, j, self.weight[piece], piece)
            if not alone:
                arc(i, i + 1, self.unknown_weight, s[i])
        path, gap, j = self._trace(last, n), inf, 0
        for p in path:
            j += len(p)
            gap = min(gap, second[j] - best[j])
        return path, gap

    def _rounded(self, s: str, so_far: float) -> tuple[list[str], float]:
        """(path, score at its end) in sums of single precision that begin with ``so_far``.

        Of candidates that are equal once rounded the one with the longest last piece stays.
        """
        n = len(s)
        best: list[float | None] = [so_far] + [None] * n
        last: list[str | None] = [None] * (n + 1)
        for i in range(n):
            node, j, alone = self.trie, i, False
            while j < n and (node := node.get(s[j])) is not None:
                j += 1
                if (piece := node.get("")) is not None:
                    alone |= j == i + 1
                    score = single(best[i] - self.weight[piece])
                    if best[j] is None or score > best[j]:
                        best[j], last[j] = score, piece
            if not alone:
                score = single(best[i] - self.unknown_weight)
                if best[i + 1] is None or score > best[i + 1]:
                    best[i + 1], last[i + 1] = score, s[i]
        return self._trace(last, n), best[n]

    def _unigram(self, text: str) -> list[int]:
        """Ids of a normalised text, unknown ones one by one."""
        ids: list[int] = []
        so_far = 0.0
        for s in self.stretches(text):
            path, gap = self.paths[s] if len(s) <= CACHE_CHARS else self._lightest(s)
            if gap > (len(s) + 2) * 2.0 ** -21 * (abs(so_far) + len(s) * self.heaviest):
                for p in path:
                    so_far = single(so_far - self.weight.get(p, self.unknown_weight))
            else:
                path, so_far = self._rounded(s, so_far)
            ids += self._ids_of(path)
        return ids

    @staticmethod
    def _trace(last: list, n: int) -> list[str]:
        path = []
        while n:
            path.append(last[n])
            n -= len(last[n])
        return path[::-1]

    # -- weights of BPE arcs
    def _merged(self, symbols: list[str]) -> list[tuple[str, str]]:
        """Carry out the merges of a short sequence in place; the merges done, in order."""
        done = []
        while len(symbols) > 1:
            k = min(range(len(symbols) - 1), key=lambda i: self.weight.get(symbols[i] + symbols[i + 1], float("inf")))
            if symbols[k] + symbols[k + 1] not in self.weight:
                break
            done.append((symbols[k], symbols[k + 1]))
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        return done

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes ``piece``; None where merges don't end in it or not in order of weight."""
        if piece not in self._splits:
            done = self._merged(symbols := list(piece))
            rising = [self.weight[a + b] for a, b in done]
            fine = len(symbols) == 1 and rising == sorted(rising) and len(set(rising)) == len({a + b for a, b in done})
            self._splits[piece] = done[-1] if fine and done else None
        return self._splits[piece]

    def _is_whole(self, piece: str) -> bool:
        if len(piece) == 1:
            return True
        if self._split(piece):
            return True
        symbols = list(piece)
        self._merged(symbols)
        return len(symbols) == 1

    def _left_alone(self, pair: tuple[str, str]) -> bool:
        """Whether the merges of the two pieces' characters end in just these two pieces."""
        left, right = pair
        if BLANK * 2 in left + right or (len(left) > 1 and not self._split(left)) or (len(right) > 1 and not self._split(right)):
            self._merged(symbols := list(left + right))
            return symbols == [left, right]
        weight, limit, among_equals = self.weight, float("inf"), False
        while True:
            across = weight.get(left + right)
            if across is not None and (across < limit or across == limit and among_equals):
                return False
            wl = weight[left] if len(left) > 1 else -1.0
            wr = weight[right] if len(right) > 1 else -1.0
            if wl < 0 and wr < 0:
                return True
            if wl > wr:  # undo the later merge; of equal ones the right one is later
                limit, among_equals = wl, False
                split = self._split(left)
                left = split[1]
            else:
                limit, among_equals = wr, True
                split = self._split(right)
                right = split[0]

    # -- whole texts
    def _packed(self, text: str) -> bytes:
        """Packed ids of a normalised text, unknown ones one by one."""
        if not self.bpe:
            return np.array(self._unigram(text), self.width).tobytes()
        look, long = self.paths.__getitem__, self.shortest_path
        return b"".join([look(s) if len(s) <= CACHE_CHARS else long(s) for s in self.stretches(text)])

    def _key(self, key: str) -> bytes:
        """Packed ids of a stretch between blanks or line feeds; at a text's start the dummy prefix is its blank."""
        return self._packed(key if key[0] == "\n" else BLANK + key.removeprefix(" "))

    def _plain(self, text: str) -> bool:
        """Whether every blank stands alone between other characters, so that each begins a stretch."""
        return (self.bpe and self.dummy_prefix and not self.squeeze and not self.rewrites and text[0] not in " \n" and "  " not in text and BLANK not in text)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        ids, sizes = self.table.encode(texts)
        if self.byte_fallback or not len(ids):
            return ids, sizes
        again = ids == self.unknown
        again[1:] &= again[:-1].copy()  # an unknown id right after another, in one text
        starts = np.cumsum(sizes) - sizes
        again[starts[sizes > 0]] = False
        gone = np.concatenate(([0], np.cumsum(again)))
        return ids[~again], sizes - (gone[starts + sizes] - gone[starts])

    def _output(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(BLANK, " ").encode()

    def decode(self, ids: np.ndarray) -> str:
        """The inverse transducer: outputs of the ids, less the dummy prefix."""
        raw = b"".join(map(self.out.__getitem__, ids.tolist()))
        if self.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_loaded: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    """The worker's compiled model."""
    if path not in _loaded:
        _loaded[path] = PieceTransducer.load(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array<int>): the model's ids of every whole text, without begin and end.

    Null or empty text: an empty array. Null ids and repeated rows are kept; an empty table
    gives none; other columns are ignored. A text's time and memory grow with its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(path)
        for docs_of, texts in text_slices(batches, TEXT_BYTES):
            ids, sizes = fst.encode_many(texts)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([docs_of, pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the texts of ``ids`` (null or empty ids: an empty text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(path)
        for piece in slices(batches):
            texts = [fst.decode(np.array(x, np.int64)) for x in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, n_fallback (byte ids), ids_crc32 (little-endian unsigned 32-bit), decoded_ok.

    Encodes and decodes every whole text in one pass. ``decoded_ok``: the decoded text is the
    normalised one (U+2581 in a text comes back as a blank). Edge cases as in ``encode``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(path)
        is_byte = np.zeros(len(fst.pieces), bool)
        is_byte[list(fst.byte_ids.values())] = True
        for docs_of, texts in text_slices(batches, TEXT_BYTES):
            flat, sizes = fst.encode_many(texts)
            stops = np.cumsum(sizes).tolist()
            rows = []
            for text, stop, n in zip(texts, stops, sizes.tolist()):
                ids = flat[stop - n:stop]
                rows.append((n, int(is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()),
                             fst.decode(ids) == (fst.normalise(text)[fst.dummy_prefix:]).replace(BLANK, " ")))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [docs_of, *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.bool_())],
                names=["doc_id", "n_tokens", "n_fallback", "ids_crc32", "decoded_ok"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, n_fallback long, ids_crc32 long, decoded_ok boolean")
