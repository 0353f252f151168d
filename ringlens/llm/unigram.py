"""Pieces with scores, and the Viterbi search over an Aho-Corasick automaton that op 1 and op 7 share.

Tie rule (the public unigram tokenizer's): of equally good paths to a position the one whose last piece is longer wins;
a character that no one-character piece covers may also be an unknown piece of score ``min - 10``, which wins only if it
is strictly better than every match. Scores add up in double precision.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass
from heapq import merge
from math import inf
from operator import itemgetter

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the public tokenizer
MAX_PIECES = 1_000_000  # a piece table is sent to every task, so its size is bounded


@dataclass(frozen=True)
class Pieces:
    """What a task needs of a model: (piece, id, score) of the ordinary pieces, and how to spell all ids."""

    pieces: tuple[tuple[str, int, float], ...]
    spelling: tuple[bytes | None, ...]  # by id: its UTF-8 bytes, None for control ids
    byte_ids: tuple[int, ...]  # the ids of the 256 byte pieces, or none
    unknown_id: int
    dummy_prefix: bool
    name: str  # the same for the same file


def load_pieces(path: str) -> Pieces:
    """Reads a SentencePiece model file on the driver. Only models without text normalisation are taken."""
    import hashlib

    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as f:
        raw = f.read()
    model = proto.ModelProto()
    model.ParseFromString(raw)
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError(f"{path}: only models with identity normalisation are supported")
    if len(model.pieces) > MAX_PIECES:
        raise ValueError(f"{path}: more than {MAX_PIECES} pieces")
    kind = proto.ModelProto.SentencePiece
    spelling: list[bytes | None] = [None] * len(model.pieces)
    pieces, byte_ids, unknown = [], [], 0
    for i, p in enumerate(model.pieces):
        if p.type == kind.NORMAL:
            pieces.append((p.piece, i, p.score))
            spelling[i] = p.piece.replace(SPACE, " ").encode()
        elif p.type == kind.BYTE:
            byte_ids.append(i)
            spelling[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type == kind.UNKNOWN:
            unknown = i
            spelling[i] = model.trainer_spec.unk_surface.encode()
        elif p.type == kind.USER_DEFINED:
            raise ValueError(f"{path}: user defined pieces are not supported")
    if byte_ids and len(byte_ids) != 256:
        raise ValueError(f"{path}: {len(byte_ids)} byte pieces")
    return Pieces(
        tuple(pieces), tuple(spelling), tuple(byte_ids), unknown, spec.add_dummy_prefix, hashlib.sha256(raw).hexdigest()
    )


class Recent(dict):
    """A map filled by ``make`` that forgets what was not asked for lately: it holds two generations of ``limit``."""

    def __init__(self, make, limit: int = 80_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Segmenter:
    """Best segmentation of texts into pieces; ``encode`` gives ids, ``count`` only their number."""

    def __init__(self, table: Pieces):
        import ahocorasick

        self.table = table
        self.trie = ahocorasick.Automaton()
        for piece, i, score in table.pieces:
            self.trie.add_word(piece, (len(piece), score, i))
        if table.pieces:
            self.trie.make_automaton()
        self.unknown = min((s for _, _, s in table.pieces), default=0.0) - UNKNOWN_PENALTY
        self.ones = {p for p, _, _ in table.pieces if len(p) == 1}
        joined = {c for p, _, _ in table.pieces if len(p) > 1 for c in p} - {SPACE}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in table.pieces):
            self.chunk = re.compile("(?s).+")
        else:
            # no piece crosses from another character to a space sign, nor into a character that only stands alone:
            # the best path of a text is the best paths of these chunks, one after the other
            one = "[" + "".join(map(re.escape, sorted(joined))) + "]+" if joined else "(?!)"
            self.chunk = re.compile(f"(?s){SPACE}*{one}|{SPACE}+|.")
        self.ids = Recent(self._ids)
        self.counts = Recent(self._count)

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        return self.chunk.findall((SPACE if self.table.dummy_prefix else "") + text.replace(" ", SPACE))

    def _matches(self, chunk: str):
        return self.trie.iter(chunk) if self.table.pieces else ()

    def _edges(self, chunk: str):
        """(end, (size, score, id)) of all pieces that match and, after the matches of the same end, of the unknown piece (id -1)."""
        if self.ones.issuperset(chunk):
            return self._matches(chunk)
        lone = ((at, (1, self.unknown, -1)) for at, c in enumerate(chunk) if c not in self.ones)
        return merge(self._matches(chunk), lone, key=itemgetter(0))

    def _ids(self, chunk: str) -> bytes:
        """The ids of a chunk as 32-bit integers, which take a fraction of the memory of a tuple."""
        # by the place of a piece's last character; the place before the first character is -1, the last one here
        best = [-inf] * len(chunk) + [0.0]
        last = [None] * len(chunk)
        # at one end the automaton follows its output links from the longest match to the shortest
        for end, piece in self._edges(chunk):
            size, score, _ = piece
            total = best[end - size] + score
            if total > best[end]:
                best[end], last[end] = total, piece
        out: list[int] = []
        end = len(chunk) - 1
        while end >= 0:
            size, _, i = last[end]
            if i >= 0:
                out.append(i)
            elif self.table.byte_ids:
                out.extend([self.table.byte_ids[b] for b in reversed(chunk[end].encode())])
            elif not out or out[-1] != self.table.unknown_id:  # a run of unknown characters is one piece
                out.append(self.table.unknown_id)
            end -= size
        out.reverse()
        return array("i", out).tobytes()

    def _count(self, chunk: str) -> int:
        """Number of pieces on the best path: the same search, which carries the count instead of back links."""
        n, unknown, byte_ids = len(chunk), self.unknown, self.table.byte_ids
        best: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        run = [False] * (n + 1)  # ends in an unknown piece that was not spelled in bytes
        single = [False] * (n + 1)
        done = 0

        def close(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if not single[done]:
                    score = best[done - 1] + unknown
                    if best[done] is None or score > best[done]:
                        best[done] = score
                        more = len(chunk[done - 1].encode()) if byte_ids else 1 - run[done - 1]
                        count[done], run[done] = count[done - 1] + more, not byte_ids

        for end, (size, score, _) in self._matches(chunk):
            end += 1
            close(end - 1)
            single[end] |= size == 1
            total = best[end - size] + score
            if best[end] is None or total > best[end]:
                best[end], count[end], run[end] = total, count[end - size] + 1, False
        close(n)
        return count[n]

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        found = map(self.ids.__getitem__, self.chunks(text))
        if self.table.byte_ids:
            return b"".join(found)
        out = array("i")
        for ids in map(lambda b: array("i", b), found):
            if out and ids[0] == out[-1] == self.table.unknown_id:
                ids = ids[1:]  # a run of unknown characters over several chunks
            out.extend(ids)
        return out.tobytes()

    def encode(self, text: str) -> list[int]:
        return array("i", self.encode_bytes(text)).tolist()

    def count(self, text: str) -> int:
        if not self.table.byte_ids:  # runs of unknown characters can cross chunks
            return len(self.encode(text))
        return sum(map(self.counts.__getitem__, self.chunks(text)))

    def decode_bytes(self, text: bytes) -> str:
        """The text of joined spellings; bytes that are no UTF-8 become U+FFFD."""
        text = text.decode("utf-8", "replace")
        return text[1:] if self.table.dummy_prefix and text.startswith(" ") else text

    def decode(self, ids) -> str:
        """The text that the ids spell; control ids spell nothing."""
        return self.decode_bytes(b"".join(self.table.spelling[i] or b"" for i in ids))


_SEGMENTERS: dict[str, Segmenter] = {}


def segmenter(table: Pieces) -> Segmenter:
    """The segmenter of a model, built once per Python worker."""
    if table.name not in _SEGMENTERS:
        _SEGMENTERS.clear()
        _SEGMENTERS[table.name] = Segmenter(table)
    return _SEGMENTERS[table.name]
