"""SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary is a byte-pair model with byte fallback: its encoding of a text is the one path through the
lattice of pieces in which any two neighbours are what merging makes of their joint characters. So a
step from one piece to the next is admissible or not (a fixed table, worked out once a pair); one automaton
pass gives the pieces that end at each boundary, and each boundary keeps one surviving backpointer. Only boundaries within the longest piece of the front can be
extended; where all their paths meet in one boundary, the ids before it are committed and forgotten.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.text import as_text, id_type, map_rows

SPACE = "▁"
# No piece holds a line break, nor a space after another character: all paths meet there. Where no piece
# holds letters beside other characters (as the vocabulary tells), they meet at the ends of letter runs, too.
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")
NUMERIC = r"\d_\u00b2\u00b3\u00b9\u00bc-\u00be"  # word characters that are no letters: digits, superscripts, fractions
RUNS = re.compile(rf"{SPACE}*[^\W{NUMERIC}]+|{SPACE}*(?:(?![{SPACE}\n])[\W{NUMERIC}])+|{SPACE}+|\n+")
CACHE = 300_000  # segments remembered by a worker, and pairs of pieces
UNKNOWN = -1  # a character without a piece, which stands as its bytes
COMMIT = 64  # characters between looks for a common boundary


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Vocabulary, admissible neighbours and the segments met so far."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: model.get_score(i) for i in plain}
        self.longest = max(map(len, self.ids))
        self.ends = ahocorasick.Automaton()
        for name, i in self.ids.items():
            self.ends.add_word(name, (len(name), i))
        self.ends.make_automaton()
        byte = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.bytes = [byte[b] for b in range(256)]
        self.size = size
        surfaces = [b""] * size
        for i in plain:
            surfaces[i] = names[i].replace(SPACE, " ").encode()
        for b, i in byte.items():
            surfaces[i] = bytes([b])
        self.surfaces = surfaces
        self.names = names
        self.split = (RUNS if all(len(RUNS.findall(n)) == 1 for n in self.ids) else SEGMENT).findall
        self.pairs: dict[int, bool] = {}
        self.known_edges: dict[int, tuple | None] = {}  # at most one entry a piece
        self.segments: dict[str, bytes] = {}

    def merged(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """Byte-pair merging by hand, only for the short strings of one or two pieces: the parts left over, and for
        each merge its score and the first and last part before it."""
        parts, scores, steps = list(text), self.scores, []
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts, steps
            steps.append((best, parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def edges(self, piece: int) -> tuple[list[tuple[str, float]], list[tuple[str, float]]] | None:
        """What stands at the left and at the right edge while the characters of a piece merge, each with the score of
        the merge that replaces it. None if merging does not give the piece, or not by falling scores."""
        found = self.known_edges.get(piece, False)
        if found is False:
            name = self.names[piece]
            parts, steps = self.merged(name)
            order = [score for score, _, _ in steps]
            found = None
            if parts == [name] and order == sorted(order, reverse=True):
                found = tuple(
                    [(part, s) for (part, s), after in zip(side, [*side[1:], (name, 0.0)]) if part != after[0]]
                    + [(name, float("-inf"))]
                    for side in ([(first, s) for s, first, _ in steps], [(last, s) for s, _, last in steps])
                )
            self.known_edges[piece] = found
        return found

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether merging the characters of two pieces gives the two again. Each piece merges as it does alone until
        a merge across the border comes first; of equal scores the leftmost goes first."""
        a, b = self.edges(left), self.edges(right)
        if a is None or b is None:
            names = self.names
            return self.merged(names[left] + names[right])[0] == [names[left], names[right]]
        ending, starting, scores = a[1], b[0], self.scores
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = ending[i], starting[j]
            across = scores.get(x + y)
            if across is not None and across > until_x and across >= until_y:
                return False
            if i + 1 == len(ending) and j + 1 == len(starting):
                return True
            if until_x >= until_y and i + 1 < len(ending):
                i += 1
            else:
                j += 1

    def admissible(self, left: int, right: int) -> bool:
        """Whether two pieces may be neighbours; UNKNOWN characters never merge."""
        fits = left < 0 or right < 0 or self.stays_apart(left, right)
        if len(self.pairs) >= CACHE:
            self.pairs.clear()
        self.pairs[left << 32 | right] = fits
        return fits

    def search(self, text: str) -> list[int]:
        """Ids of a text already in piece spelling, committed as soon as all paths agree."""
        out: list[int] = []
        known, admissible, base = self.pairs.get, self.admissible, 0
        back, last = [0], [UNKNOWN]  # by boundary - base: where the surviving piece that ends there begins, and its id
        settled = 0
        for end, (length, piece) in self.ends.iter(text):  # longest first at each end
            if end < settled:
                continue
            while settled < end:
                settled += 1
                self.unknown(text, settled, back, last)
            i = end + 1 - length
            if i:
                before = last[i - base]
                fits = known(before << 32 | piece)
                if not (admissible(before, piece) if fits is None else fits):
                    continue
            back.append(i)
            last.append(piece)
            settled = end + 1
            if len(back) > COMMIT:
                meeting = self.meeting(back, base)
                if meeting > base:
                    out += self.path(text, back, last, base, meeting)
                    back, last, base = back[meeting - base :], last[meeting - base :], meeting
        while settled < len(text):
            settled += 1
            self.unknown(text, settled, back, last)
        return out + self.path(text, back, last, base, settled)

    def unknown(self, text: str, end: int, back: list[int], last: list[int]) -> None:
        """A boundary that no piece reaches lies behind a character without a piece."""
        if text[end - 1] in self.ids:
            raise ValueError(f"no path to {end} in {text!r}")
        back.append(end - 1)
        last.append(UNKNOWN)

    def meeting(self, back: list[int], base: int) -> int:
        """The last boundary that all paths to boundaries a piece can still extend have in common."""
        top = base + len(back) - 1
        open_ends = set(range(max(base, top - self.longest + 1), top + 1))
        while len(open_ends) > 1:
            top = max(open_ends)
            open_ends.remove(top)
            open_ends.add(back[top - base])
        return open_ends.pop()

    def path(self, text: str, back: list[int], last: list[int], base: int, end: int) -> list[int]:
        ids: list[int] = []
        while end > base:
            start, piece = back[end - base], last[end - base]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.bytes[b] for b in reversed(text[start:end].encode())]
            end = start
        return ids[::-1]

    def segment(self, text: str) -> bytes:
        found = array("i", self.search(text)).tobytes()
        if len(text) <= 64:
            if len(self.segments) >= CACHE:
                self.segments.clear()
            self.segments[text] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<i4")
        known, new = self.segments.get, self.segment
        spelled = SPACE + text.replace(" ", SPACE)
        return np.frombuffer(b"".join([known(s) or new(s) for s in self.split(spelled)]), "<i4")

    def decode(self, ids) -> str:
        """The text of a list of ids; the space put before the first word goes. Ids out of range and control
        pieces stand for nothing, broken byte sequences for replacement marks."""
        surfaces, size = self.surfaces, self.size
        if isinstance(ids, np.ndarray) and (not len(ids) or (ids.min() >= 0 and ids.max() < size)):
            joined = b"".join([surfaces[i] for i in ids.tolist()])
        else:
            joined = b"".join([surfaces[i] for i in ids if i is not None and 0 <= i < size])
        return joined.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, "<i4")
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind), type=pa.list_(pa.field("element", kind)))


def encode(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ids (array of int), n_ids, and exact: whether decoding gives the text back.

    NULL and empty texts have no ids. The mark U+2581 is a space to the model, so a text that holds it
    is the only kind that does not come back (exact is false). Repeated rows each give a row.
    """
    path = path or model_file()
    kept = ", ".join(f"`{c}` {id_type(docs, c)}" for c in keep)

    def run(slabs):
        model = pieces(path)
        for *columns, texts in slabs:
            texts = as_text(texts)
            ids = [model.encode(t) for t in texts]
            yield {
                **dict(zip(keep, columns)),
                "ids": _lists(ids, pa.int32()),
                "n_ids": [len(i) for i in ids],
                "exact": [model.decode(i) == t for i, t in zip(ids, texts)],
            }

    return map_rows(docs, [*keep, "text"], f"{kept}, ids array<int>, n_ids long, exact boolean", run)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text of its ids; NULL lists give empty texts."""
    path = path or model_file()

    def run(slabs):
        model = pieces(path)
        for keys, lists in slabs:
            yield {"doc_id": keys, "text": [model.decode(i or []) for i in lists.to_pylist()]}

    return map_rows(encoded, ["doc_id", "ids"], f"doc_id {id_type(encoded)}, text string", run)


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_sha256 (over the ids as little-endian 32-bit numbers), decoded_sha256 (over the decoded text) and
    exact, of every text."""
    path = path or model_file()
    schema = f"doc_id {id_type(docs)}, n_ids long, ids_sha256 string, decoded_sha256 string, exact boolean"

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(slabs):
        model = pieces(path)
        for keys, texts in slabs:
            texts = as_text(texts)
            ids = [model.encode(t) for t in texts]
            decoded = [model.decode(i) for i in ids]
            yield {
                "doc_id": keys,
                "n_ids": [len(i) for i in ids],
                "ids_sha256": [sha(i.tobytes()) for i in ids],
                "decoded_sha256": [sha(t.encode()) for t in decoded],
                "exact": [a == b for a, b in zip(decoded, texts)],
            }

    return map_rows(docs.select(F.col("doc_id"), F.col("text")), ["doc_id", "text"], schema, run)
