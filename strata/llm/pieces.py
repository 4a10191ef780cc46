"""SentencePiece BPE, encoded exactly by backtracking over longest matches, and decoded.

Merging neighbours by score gives one result per text, and that result can be recognised: it is the only sequence of
pieces in which every two neighbours, merged anew from their characters, come out as the same two pieces. So the
encoder looks for that sequence: it takes the longest piece that matches (all matches come from one Aho-Corasick pass),
accepts it if it is compatible with the piece before, else tries the next shorter one, and steps back when none is left.
A bit per position records that no encoding leads on from there, so each position fails once at most.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
from collections.abc import Iterable, Sequence

import ahocorasick
from pyspark.sql import DataFrame

from strata.llm.common import append_columns
from strata.llm.vocab import WordCache

SPACE = "▁"
# Remembered answers about pairs of pieces, per Python worker.
PAIRS = 1 << 18
# Words in each generation of a cache.
WORDS = 300_000


def _bytewise(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("piece-bytes", _bytewise)


class PieceModel:
    """Pieces and scores of a BPE model with byte fallback, no normaliser but the space symbol, and a dummy prefix."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.end_id = model.eos_id()
        self.ids = {names[i]: i for i in plain}
        self.score = {names[i]: model.get_score(i) for i in plain}
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError(f"{path}: not a model with byte fallback")
        self.longest = max(map(len, self.ids), default=1)
        self.surface = {str(i): names[i].replace(SPACE, " ").encode() for i in plain}
        self.surface |= {str(i): bytes([b]) for b, i in self.byte_ids.items()}
        self.surface[str(model.unk_id())] = " ⁇ ".encode()
        self.silent = {str(i) for i in range(n) if model.is_control(i)}
        self.surface |= dict.fromkeys(self.silent, b"")
        self.spaced = {str(i) for i in plain if names[i].startswith(SPACE)}
        self.pair = functools.lru_cache(PAIRS)(self._pair)
        # Pieces that merging never leaves as they are can't be part of a result.
        self.machine = ahocorasick.Automaton()
        for piece in self.ids:
            if self.merge(piece) == (piece,):
                self.machine.add_word(piece, len(piece))
        self.machine.make_automaton()
        # A word can be encoded by itself if no piece holds a space symbol behind another character.
        self.separable = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.line_ends = not any("\n" in p for p in self.ids)
        self.head = WordCache(lambda word: self._ids(SPACE + word), WORDS)
        self.bare = WordCache(self._ids, WORDS)
        self.newline = self._ids("\n")

    def merge(self, text: str) -> tuple[str, ...]:
        """The definition: of all neighbours whose union is a piece, merge those of the highest score, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return tuple(parts)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _pair(self, left: str, right: str) -> bool:
        return self.merge(left + right) == (left, right)

    def split(self, text: str) -> list[str]:
        """The pieces of a text in which spaces are space symbols already. A character without a piece is one of its own."""
        n = len(text)
        ends: list[list[int]] = [[] for _ in range(n)]
        for last, length in self.machine.iter(text):
            ends[last - length + 1].append(last + 1)  # by start, shortest first
        open_at = bytearray(b"\xff") * (n // 8 + 1)
        pieces: list[str] = []
        tried: list[int] = []  # by piece in the result: how many of its shorter alternatives are left
        at, left = 0, -1
        while at < n:
            options = ends[at] or [at + 1]
            if left < 0:
                left = len(options)
            before = pieces[-1] if pieces else None
            while left:
                left -= 1
                end = options[left]
                piece = text[at:end]
                if open_at[end >> 3] >> (end & 7) & 1 and (before is None or self.pair(before, piece)):
                    pieces.append(piece)
                    tried.append(left)
                    at, left = end, -1
                    break
            else:
                open_at[at >> 3] &= ~(1 << (at & 7))
                if not pieces:
                    raise AssertionError("a text has one encoding")
                at -= len(pieces.pop())
                left = tried.pop()
        return pieces

    def _ids(self, text: str) -> str:
        out: list[int] = []
        for piece in self.split(text):
            own = self.ids.get(piece)
            out += [own] if own is not None else [self.byte_ids[b] for b in piece.encode()]
        return " ".join(map(str, out))

    def encode(self, text: str) -> str:
        """The ids in decimal, joined by one space, without an end id. Equal to the library's for every text."""
        if not text:
            return ""
        if not self.separable:
            return self._ids(SPACE + text.replace(" ", SPACE))
        out = []
        for k, line in enumerate(text.split("\n") if self.line_ends else [text]):
            if k:
                out.append(self.newline)
            if k and not line:
                continue
            words = line.split(" ")
            if "" in words or SPACE in line:
                # Runs of spaces belong to the word behind them.
                out += [self.bare[w] for w in _runs((SPACE if not k else "") + line.replace(" ", SPACE))]
            else:
                out.append((self.bare if k else self.head)[words[0]])
                out += map(self.head.__getitem__, words[1:])
        return " ".join(out)

    def decode(self, ids: Sequence[str]) -> str:
        """The text of decimal ids. Control pieces are silent, the space of the dummy prefix goes, and each byte that is
        no part of a UTF-8 character becomes U+FFFD."""
        content = b"".join(map(self.surface.__getitem__, ids))
        if next((i for i in ids if i not in self.silent), "") in self.spaced:
            content = content[1:]
        return content.decode("utf-8", "piece-bytes")


def _runs(text: str) -> Iterable[str]:
    """Cut before every space symbol that follows another character."""
    start = 0
    for i in range(1, len(text)):
        if text[i] == SPACE and text[i - 1] != SPACE:
            yield text[start:i]
            start = i
    yield text[start:]


@functools.lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def round_trip(docs: DataFrame, model: str, text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Adds ``n_tokens, ids_sha256, decoded_sha256`` (and ``piece_ids``, the decimal ids) to ``docs``.

    Ids are those of the sentencepiece library with an end id and nothing else added; the decoded text comes from those
    ids. NULL and empty texts have the end id alone and decode to the empty text. All rows and other columns stay; a
    column with the name of a new one gives way to it. An empty table gives an empty result.
    """
    types = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    if keep_ids:
        types["piece_ids"] = "string"

    def make():
        pieces = piece_model(model)

        def f(texts: list[str]) -> tuple[list, ...]:
            out: tuple[list, ...] = ([], [], [], [])
            for text in texts:
                ids = f"{pieces.encode(text)} {pieces.end_id}".lstrip()
                each = ids.split(" ")
                decoded = pieces.decode(each)
                row = (len(each), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return out if keep_ids else out[:3]

        return f

    return append_columns(docs, text_col, make, **types)


def encoded_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` per row."""
    return round_trip(docs.select(id_col, text_col), model, text_col).drop(text_col).select(id_col, "n_tokens", "ids_sha256", "decoded_sha256")

