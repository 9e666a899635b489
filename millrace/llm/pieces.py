r"""SentencePiece ids of whole texts, and texts of ids, for models of merge type with byte fallback.

Method: merge-type prefix table. Where pieces are made by merging the best pair over and over, a row of pieces is the
library's own exactly if each two neighbours are, so every prefix of a text has a unique last piece. An automaton
(Aho-Corasick over all pieces) gives the pieces that end at each place; the one that is compatible with the last piece
of the prefix before it is entered in the table; the ids are recovered from the end of the text backwards.

Two pieces are compatible if no merge across their bound would have come before one of the merges that made them, which
is read off the right edge of the first one's merges and the left edge of the second one's. Where a model has a piece
whose parts come later than itself, the order of merges can't be read off ids, and the two are merged anew instead.

A text is cut before it is encoded where no piece can reach across: at white space, if no piece has it behind another
character, and around characters that no piece has; those become bytes. Workers remember the parts they meet often.

Defined cases: null text counts as empty (no ids, decoded to an empty text); an empty table gives no rows; there are no
ties, repeated rows give repeated rows; other columns of the input are ignored, whatever their names; texts are encoded
whole, however long; bytes that are no UTF-8 read as U+FFFD. As in the library, a decoded text has no first space that encoding put there, and every
U+2581 of a text comes back as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .words import expand

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters of the parts that a worker remembers, how many parts in each of two generations, and characters of a text
#: that are held as parts at once.
SHORT, REMEMBERED, WINDOW = 48, 1 << 18, 1 << 20
NEVER = float("inf")


class PieceModel:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError(f"{path}: only models of merge type that leave texts as they are")
        if not model.trainer_spec.byte_fallback or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: only models with byte fallback, and without user-defined or unused pieces")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.surface = model.trainer_spec.unk_surface
        self.of_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.to_byte = {i: b for b, i in self.of_byte.items()}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        # the best score is merged first; of equal ones the leftmost
        order = {s: r for r, s in enumerate(sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True))}
        self.rank = {p.piece: order[p.score] for p in model.pieces if p.type == NORMAL}
        self.known = {c for piece in self.ids for c in piece}
        odd = "".join(map(re.escape, sorted(self.known)))
        self.unknown = re.compile(f"[^{odd}]" if odd else "(?s:.)")
        # the finest of these cuts that leaves every piece whole, and so every bound between two parts unmerged
        letters, others = r"[^\W\d_²]", rf"(?:[^\w{SPACE}\n]|[\d_²])"
        cuts = [rf"{SPACE}*{letters}+|{SPACE}*{others}+|{SPACE}+|\n+", rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+", f"{SPACE}*[^{SPACE}]+|{SPACE}+", "(?s:.+)"]
        self.parts = next(x for x in map(re.compile, cuts) if all(x.findall(piece) == [piece] for piece in self.ids))
        spelled = [bytes([self.to_byte[i]]) if i in self.to_byte else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.lengths = np.array([len(x) for x in spelled])
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.silent = np.array([k in (UNKNOWN, CONTROL) for k in self.kinds])
        self._edges()
        self.tried: dict[int, bool] = {}
        self.remembered: dict[str, str] = {}
        self.older: dict[str, str] = {}

    # --- merges ---

    def merged(self, text: str) -> list[tuple]:
        """The pieces of a short text as trees (piece, left, right), by merging: the rule itself."""
        row = [(c, None, None) for c in text]
        while True:
            pairs = [(self.rank.get(a[0] + b[0], NEVER), i) for i, (a, b) in enumerate(zip(row, row[1:]))]
            best, i = min(pairs, default=(NEVER, 0))
            if best == NEVER:
                return row
            row[i : i + 2] = [(row[i][0] + row[i + 1][0], row[i], row[i + 1])]

    def _edges(self) -> None:
        """The parts of each piece that merging arrives at; the others never occur in a text."""
        self.halves: dict[str, tuple[str, str]] = {}
        self.calm: dict[str, bool] = {}
        self.matches = ahocorasick.Automaton()
        for piece in sorted(self.ids, key=len):
            if len(piece) > 1:
                row = self.merged(piece)
                if len(row) > 1:
                    continue
                left, right = row[0][1][0], row[0][2][0]
                self.halves[piece] = left, right
                here = self.rank[piece]
                self.calm[piece] = all(len(x) == 1 or self.calm[x] and self.rank[x] < here for x in (left, right))
        # a character that is no piece of its own may still be merged
        self.entered = [x for x in self.ids if len(x) == 1 or x in self.halves] + sorted(self.known - set(self.ids))
        self.sizes = list(map(len, self.entered))
        self.numbers = [[self.ids[x]] if x in self.ids else [self.of_byte[b] for b in x.encode()] for x in self.entered]
        for nth, x in enumerate(self.entered):
            self.matches.add_word(x, nth)
        self.matches.make_automaton()

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging leaves a and b, side by side, as they are."""
        if not (self.calm.get(a, True) and self.calm.get(b, True)):
            return [x[0] for x in self.merged(a + b)] == [a, b]
        rank, halves = self.rank, self.halves
        ends_a = ends_b = NEVER  # when the parts at the bound were merged into longer ones
        while True:
            across = rank.get(a + b, NEVER)
            if across < ends_a and across <= ends_b and across != NEVER:
                return False
            made_a = rank[a] if len(a) > 1 else -1
            made_b = rank[b] if len(b) > 1 else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                ends_a, a = made_a, halves[a][1]
            else:
                ends_b, b = made_b, halves[b][0]

    # --- texts to ids ---

    def _table(self, part: str) -> list[int]:
        """The pieces, by number, of a text whose characters all are known, from the last to the first."""
        last = [-1] * len(part)
        tried, sizes, entered = self.tried, self.sizes, self.entered
        for end, piece in self.matches.iter(part):
            if last[end] >= 0:
                continue
            begin = end - sizes[piece]
            if begin >= 0:
                pair = last[begin] << 32 | piece
                fits = tried.get(pair)
                if fits is None:
                    if len(tried) >= REMEMBERED:
                        tried.clear()
                    fits = tried[pair] = self.compatible(entered[pair >> 32], entered[piece])
                if not fits:
                    continue
            last[end] = piece
        out, at = [], len(part) - 1
        while at >= 0:
            out.append(last[at])
            at -= sizes[last[at]]
        return out

    def pieces_of(self, part: str) -> list[str]:
        return [self.entered[x] for x in reversed(self._table(part))]

    def part_ids(self, part: str) -> list[int]:
        out: list[int] = []
        at = 0
        for odd in self.unknown.finditer(part):
            self._add(out, part[at : odd.start()])
            out.extend(self.of_byte[b] for b in odd[0].encode())
            at = odd.end()
        self._add(out, part[at:] if at else part)
        return out

    def _add(self, out: list[int], part: str) -> None:
        for x in reversed(self._table(part)):
            out += self.numbers[x]

    def shown(self, part: str) -> str:
        """Decimal ids with commas of a part that was not met lately."""
        found = self.older.get(part) or ",".join(map(str, self.part_ids(part)))
        if len(part) <= SHORT:
            if len(self.remembered) >= REMEMBERED:  # parts that are met again move on, the others go
                self.older, self.remembered = self.remembered, {}
            self.remembered[part] = found
        return found

    def _windows(self, text: str) -> Iterator[list[str]]:
        """The parts of a text, so many characters at once, cut where a part begins."""
        text = self.prefix + text.replace(" ", SPACE) if text else ""
        at = 0
        while len(text) - at > WINDOW:
            # the part that the window's end cuts is left to the next one
            some = [m.span() for m in self.parts.finditer(text, at, at + WINDOW)]
            if len(some) == 1:
                some = [self.parts.match(text, at).span()]
            else:
                some.pop()
            yield [text[x:y] for x, y in some]
            at = some[-1][1]
        yield self.parts.findall(text, at)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for parts in self._windows(text):
            for part in parts:
                out += self.part_ids(part)
        return out

    def encode_shown(self, text: str) -> str:
        """The same as decimal ids joined by commas."""
        joined = []
        for parts in self._windows(text):
            found = list(map(self.remembered.get, parts))
            if None in found:
                found = [self.shown(part) if ids is None else ids for part, ids in zip(parts, found)]
            if found:
                joined.append(",".join(found))
        return ",".join(joined)

    # --- ids to texts ---

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """As the library: the space that encoding puts first goes, bytes that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        if not self.silent[ids].any():
            # bytes of characters stand between whole ones, so the row is UTF-8 if each of its runs of bytes is
            spelled = [self.spelled[expand(self.begins[some], self.lengths[some])].tobytes() for some in np.split(ids, range(1 << 20, len(ids), 1 << 20))]
            try:
                text = b"".join(spelled).decode()
                return text[1:] if self.prefix and len(ids) and self.pieces[ids[0]].startswith(SPACE) else text
            except UnicodeDecodeError:
                pass
        return self._decode_each(ids.tolist())

    def _decode_each(self, ids: list[int]) -> str:
        out: list[str] = []
        held = bytearray()
        first, dropped, kinds, pieces = True, False, self.kinds, self.pieces
        for i in ids:
            kind = kinds[i]
            if kind == BYTE:
                held.append(self.to_byte[i])
                continue
            if held:
                out.append(lenient(bytes(held)))
                held.clear()
            if first and (dropped or any(out)):
                first = False
            dropped = False
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(self.surface)
                continue
            piece = pieces[i]
            if first and self.prefix and piece.startswith(SPACE):
                piece, dropped = piece[1:], True
            out.append(piece.replace(SPACE, " "))
        if held:
            out.append(lenient(bytes(held)))
        return "".join(out)


def lenient(data: bytes) -> str:
    """UTF-8 as text; every byte that belongs to no character becomes U+FFFD."""
    out = []
    while True:
        try:
            out.append(data.decode())
            return "".join(out)
        except UnicodeDecodeError as e:
            out.append(data[: e.start].decode() + "�")
            data = data[e.start + 1 :]


@lru_cache(maxsize=2)
def model_of(path: str) -> PieceModel:
    return PieceModel(path)


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) of every row, ids in decimal, joined by commas; a map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(model)
        for batch, texts in chunks(batches, "text"):
            shown = [m.encode_shown(t.decode(errors="replace")) for t in texts]
            back = [m.decode(np.fromstring(s, np.int64, sep=",")) for s in shown]
            many = [s.count(",") + 1 if s else 0 for s in shown]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(many, pa.int64()), pa.array(shown, pa.string()), pa.array(back, pa.string())], names=["id", "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    asked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return asked.mapInArrow(run, f"id {kind}, n_tokens long, ids string, decoded string").withColumnRenamed("id", id_col)


def piece_report(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256)."""
    return encoded(docs, model, id_col, text_col).select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
