"""SentencePiece encoding and decoding as weighted finite-state transduction.

The model file is compiled into three machines:

* the normaliser: space to U+2581 and the dummy prefix (models with a
  character map of their own are refused);
* the lexicon: a trie transducer from characters to pieces, with byte pieces
  as the fallback for characters that no piece has;
* for unigram models the piece weights (minus the score); for BPE models a
  bigram acceptor over pieces that gives weight 0 to a pair of neighbours
  which the model's own merges leave as that pair, and infinity to others.

An input is composed with them position by position and the shortest path in
the tropical semiring (min, +) is its encoding. For BPE that is exact: in a
finished BPE encoding no merge crosses a piece boundary, so the merges inside
any two neighbours run as if these stood alone; and a sequence whose
neighbours all are such pairs is the encoding, since the first merge across
one of its boundaries would also happen in the pair alone. So exactly one path
has finite weight. Ties between unigram paths go to the longer last piece.

The composition runs over stretches between characters that no piece has side
by side, where every path passes, so stretches can be remembered.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import map_texts, ship, worker_cache

ship(__name__)

SPACE = "▁"
STRETCHES_KEPT, UNITS_KEPT, PAIRS_KEPT = 600_000, 200_000, 1_000_000
HEADS_KEPT = 200_000
HEAD_CHARS = 4  # of a position's text, by which the pieces that begin there are remembered
# Piece types of the model format.
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6


KEY_CHARS = 64  # of a remembered key


class _Memory(dict):
    """What ``make`` gives for a key, remembered for up to ``most`` keys at a time.

    Half of them are older ones, which come back when they are asked for again,
    so that frequent keys stay. Long keys are made anew each time, which bounds
    the bytes as well.
    """

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        got = self.older.pop(key, None)
        if got is None:
            got = self.make(key)
        if isinstance(key, int) or len(key) <= KEY_CHARS:
            if len(self) >= (self.most + 1) // 2:
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got


class Transducer:
    """A SentencePiece model (serialised ModelProto) compiled for encoding and decoding."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or (
                not norm.escape_whitespaces) or train.treat_whitespace_as_suffix:
            raise ValueError("only models that keep characters and white space are supported")
        if train.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are supported")
        self.prefix, self.bpe = norm.add_dummy_prefix, train.model_type == 2
        self.score, self.piece_id, self.bytes_of, self.byte_id = {}, {}, [], {}
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            raw = p.piece.replace(SPACE, " ").encode()
            if p.type == _USER:
                raise ValueError("models with user-defined symbols are not supported")
            if p.type == _NORMAL:
                self.piece_id[p.piece], self.score[p.piece] = i, p.score
            elif p.type == _BYTE:
                raw = bytes([int(p.piece[3:5], 16)])
                self.byte_id[raw[0]] = i
            elif p.type == _UNKNOWN:
                self.unknown, raw = i, " ⁇ ".encode()
            else:
                raw = b""
            self.bytes_of.append(raw)
        if not train.byte_fallback:
            self.byte_id = {}
        self.is_byte = np.zeros(len(proto.pieces), bool)
        self.is_byte[list(self.byte_id.values())] = True
        # the lexicon as a trie: every beginning of a piece, with the piece's id or -1
        self.trie = {p[:i]: -1 for p in self.piece_id for i in range(1, len(p))} | self.piece_id
        self.pieces = [p.piece for p in proto.pieces]
        self.length = list(map(len, self.pieces))
        self.joined = {p[i:i + 2] for p in self.piece_id for i in range(len(p) - 1)}
        self.letters = {c for p in self.piece_id for c in p}
        # where no piece has text before a space sign, or a line break at all,
        # words and line breaks can be cut before looking at characters; so can
        # signs after a word that pieces have after signs and spaces alone
        words = not any(p.lstrip(SPACE).count(SPACE) for p in self.piece_id)
        # (up to U+FFFF, beyond which patterns try a set's members one by one)
        signs = {c for c in self.letters if c <= "\uffff" and not (
            c.isalpha() or c.isdecimal() or c in "\n" + SPACE)}
        more = True
        while more:
            more = {b for a, b in self.joined if b in signs and a != SPACE and a not in signs}
            signs -= more
        sign = "".join(map(re.escape, sorted(signs)))
        word = f"{SPACE}*[{sign}]*[^{SPACE}\n{sign}]+|{SPACE}*[{sign}]+" if sign else (
            f"{SPACE}*[^{SPACE}\n]+")
        self.cut = re.compile(f"{word}|\n|{SPACE}+") if (
            words and "\n" not in self.letters) else None
        self.pairs = _Memory(self._settled, PAIRS_KEPT)
        self.heads = _Memory(self._head, HEADS_KEPT)
        self.units = _Memory(self._unit, UNITS_KEPT)
        self.stretches = _Memory(self._stretch, STRETCHES_KEPT)

    # The bigram acceptor of a BPE model.

    def _merged(self, text: str) -> list[str]:
        """What the merges leave of a short text: best score first, then leftmost."""
        parts, score, none = list(text), self.score.get, -math.inf
        gains = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) > none:
            at = gains.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def _settled(self, pair: int) -> float:
        """Weight of two neighbours, numbered before * len(pieces) + after.

        The unknown piece as the first one stands for the start of the text.
        """
        before, after = divmod(pair, len(self.pieces))
        parts = [self.pieces[after]] if before == self.unknown else [
            self.pieces[before], self.pieces[after]]
        return 0.0 if self._merged("".join(parts)) == parts else math.inf

    # Composition with the lexicon and the shortest path.

    def _head(self, head: str) -> tuple[tuple[int, ...], bool]:
        """Pieces that a text beginning with ``head`` begins with, within it, shortest
        first, and whether the lexicon has longer beginnings."""
        found, find = [], self.trie.get
        for end in range(1, len(head) + 1):
            piece = find(head[:end])
            if piece is None:
                return tuple(found), False
            if piece >= 0:
                found.append(piece)
        return tuple(found), len(head) == HEAD_CHARS

    def _starting(self, text: str, start: int) -> list[int]:
        """Pieces that begin at a position, shortest first."""
        end = start + HEAD_CHARS
        found, longer = self.heads[text[start:end]]
        found = list(found)
        if longer:
            find = self.trie.get
            for end in range(end + 1, len(text) + 1):
                piece = find(text[start:end])
                if piece is None:
                    break
                if piece >= 0:
                    found.append(piece)
        return found

    def _only_path(self, text: str) -> list[int]:
        """Piece ids of the path of weight 0 of a BPE model, there being no other finite one.

        Depth first, the longest piece first. One path leads to a position, so
        one from which no pair goes on is closed for good and each position is
        entered once at most.
        """
        n, before, at = len(text), self.unknown, 0
        pairs, size, length = self.pairs, len(self.pieces), self.length
        path, left, closed = [], [self._starting(text, 0)], set()
        while at < n:
            options = left[-1]
            while options:
                piece = options.pop()
                end = at + length[piece]
                if end not in closed and pairs[before * size + piece] == 0.0:
                    path.append(piece)
                    before, at = piece, end
                    if end < n:
                        left.append(self._starting(text, end))
                    break
            else:
                if not path:
                    raise ValueError(f"no path through {text!r}")
                closed.add(at)
                left.pop()
                at -= length[path.pop()]
                before = path[-1] if path else self.unknown
        return path

    def _path(self, text: str) -> list[int]:
        """Piece ids of the shortest path over a text of letters of the vocabulary.

        States are positions, for BPE models with the last piece.
        """
        if self.bpe:
            return self._only_path(text)
        n, find = len(text), self.trie.get
        cost, last = [math.inf] * (n + 1), [-1] * (n + 1)
        cost[0] = 0.0
        for start in range(n):
            if cost[start] == math.inf:
                continue
            for end in range(start + 1, n + 1):
                piece = find(text[start:end])
                if piece is None:
                    break
                if piece < 0:
                    continue
                total = cost[start] - self.score[text[start:end]]
                if total < cost[end]:
                    cost[end], last[end] = total, piece
        out, at = [], n
        while at:
            if last[at] < 0:
                raise ValueError(f"no path through {text!r}")
            out.append(last[at])
            at -= self.length[last[at]]
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        """Ids of a text that every path leaves at both ends."""
        ids = []
        if unit[0] not in self.letters:
            raw = unit.encode("utf-8", "surrogatepass")
            ids = [self.byte_id[b] for b in raw] if self.byte_id else [self.unknown]
        elif not self.bpe and any(c not in self.piece_id for c in unit):
            raise ValueError("a unigram model must have each of its letters as a piece")
        else:
            ids = self._path(unit)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stretch(self, text: str) -> bytes:
        inside = [*map(self.joined.__contains__, map(add, text, text[1:]))]
        units, start = [], 0
        for _ in range(len(inside) - sum(inside)):
            end = inside.index(False, start) + 1
            units.append(self.units[text[start:end]])
            start = end
        if not units:
            return self._unit(text)
        units.append(self.units[text[start:]])
        return b"".join(units)

    def encode(self, text: str) -> bytes:
        """Ids as uint32 little-endian; an empty text has none."""
        if not text:
            return b""
        text = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        parts = self.cut.findall(text) if self.cut else [text]
        return b"".join(map(self.stretches.__getitem__, parts))

    def byte_pieces(self, ids: bytes) -> int:
        """How many of the ids are byte pieces."""
        return int(np.count_nonzero(self.is_byte[np.frombuffer(ids, "<u4")]))

    def decode(self, ids) -> str:
        """The text of ids: byte pieces as bytes, one dummy space cut off."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _machine(model: bytes) -> Transducer:
    return worker_cache(f"transducer-{zlib.crc32(model)}", lambda: Transducer(model))


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, ids, n_pieces, n_bytes): piece ids of each whole text, uint32 little-endian.

    ``n_bytes`` counts byte-fallback pieces. Null texts count as empty (no
    pieces). The model file is read on the driver and shipped. One row per
    input row; a text of any length is one composition, cut where no piece can
    cross.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def kernel(texts: list[str]) -> list:
        machine = _machine(model)
        ids = [machine.encode(t) for t in texts]
        views = [memoryview(x).cast("I") for x in ids]
        return [ids, [len(v) for v in views], list(map(machine.byte_pieces, ids))]

    return map_texts(docs, id_col, text_col, kernel, "ids binary, n_pieces long, n_bytes long")


def decode_pieces(encoded: DataFrame, model_path: str, id_col: str = "id",
                  ids_col: str = "ids") -> DataFrame:
    """(id, text): the texts of piece ids (null: empty)."""
    with open(model_path, "rb") as f:
        model = f.read()
    base = encoded.select(F.col(id_col).alias("id"), F.coalesce(
        F.col(ids_col), F.lit(b"")).alias("ids"))
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        machine = _machine(model)
        for batch in batches:
            texts = [machine.decode(memoryview(x).cast("I"))
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())],
                                             names=["id", "text"])

    return base.mapInArrow(run, f"id {id_type}, text string")


def round_trips(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_pieces, n_bytes, ids_crc32, decoded[, ids]): encode and decode in one pass.

    ``decoded`` is the text that the ids give back; it differs from the text
    only where that has U+2581, which decodes as a space. ``ids`` are uint32
    little-endian.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def kernel(texts: list[str]) -> list:
        machine = _machine(model)
        pieces, byte_pieces, checks, decoded, kept = [], [], [], [], []
        for text in texts:
            ids = machine.encode(text)
            view = memoryview(ids).cast("I")
            pieces.append(len(view))
            byte_pieces.append(machine.byte_pieces(ids))
            checks.append(zlib.crc32(ids))
            decoded.append(machine.decode(view))
            if with_ids:
                kept.append(ids)
        return [pieces, byte_pieces, checks, decoded, *([kept] if with_ids else [])]

    return map_texts(docs, id_col, text_col, kernel,
                     "n_pieces long, n_bytes long, ids_crc32 long, decoded string"
                     + (", ids binary" if with_ids else ""))
