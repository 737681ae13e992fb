"""The piece lattice of a SentencePiece merge model: encoding as the best path, and chunk transfer matrices.

In a merge model a row of pieces is the encoding of its text exactly if every two neighbours are the
encoding of their own concatenation: a merge across a border would show in the two pieces beside it. So
a step from piece x to piece y weighs 0 if x, y encode themselves that way and minus infinity if not, and
the encoding is the one path of weight 0 through the lattice of pieces, found by a max-plus scan.
"""

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = "▁"
CACHE = 150_000      # entries of a generation of what a worker remembers; no effect on results
NEVER = -np.inf
State = tuple[int, int, int]


class Pieces:
    """Piece table, the step weights and the lattice scan.

    Pieces go by their id, a character without a piece by ``width`` plus its code point.
    """

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)   # only its table is read
        names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        normal = [k for k in range(len(names)) if not (
            model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))]
        self.bytes = {int(names[k][3:5], 16): k for k in range(len(names)) if model.is_byte(k)}
        self.ids = {names[k]: k for k in normal}
        self.score = {names[k]: model.get_score(k) for k in normal}
        self.names, self.width, self.longest = names, len(names), max(map(len, self.ids))
        self.joins = {p[n:n + 2] for p in self.ids for n in range(len(p) - 1)}
        # a piece that no merges lead to never occurs; the others are kept in a tree by their characters
        self.tree: dict = {}
        for p, k in self.ids.items():
            if self.merged(p) == [p]:
                node = self.tree
                for c in p:
                    node = node.setdefault(c, {})
                node[""] = k
        # a text falls apart where no piece joins two characters; the frequent such places are found by pattern
        self.blanks_lead = not any(j[1] == BLANK != j[0] for j in self.joins)
        self.lines_part = not any("\n" in p for p in self.ids)
        line = "\n" if self.lines_part else ""
        self.unit = re.compile(f"{BLANK}*[^{BLANK}{line}]+|{BLANK}+|\n" if self.blanks_lead else r"(?s).+")
        # what was seen lately, each with the generation before it, from which it takes over what is asked for again
        self.pairs: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.older_units: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def name(self, piece: int) -> str:
        return self.names[piece] if piece < self.width else chr(piece - self.width)

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: the best-scored pair first, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.score[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                     if a + b in self.score]
            if not found:
                break
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def step(self, x: int, y: int) -> bool:
        """Whether a step from piece x to piece y weighs 0."""
        key = x << 32 | y
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE:
                self.older_pairs, self.pairs = self.pairs, {}
            known = self.older_pairs.get(key)
            if known is None:
                a, b = self.name(x), self.name(y)
                known = a[-1] + b[0] not in self.joins or self.merged(a + b) == [a, b]
            self.pairs[key] = known
        return known

    def at(self, s: str, j: int) -> list[tuple[int, int]]:
        """Pieces that start at ``j`` with their end; a character without a piece stands for itself."""
        out, node, k, n = [], self.tree.get(s[j]), j + 1, len(s)
        if node is None or "" not in node:
            out.append((self.width + ord(s[j]), k))
        while node is not None:
            if "" in node:
                out.append((node[""], k))
            if k == n:
                break
            node = node.get(s[k])
            k += 1
        return out

    def scan(self, s: str, start: int, stop: int, before: int = -1) -> list[int]:
        """For each position up to ``stop`` the piece that ends there on the path of weight 0 from ``start``.

        ``before`` is the piece that ends at ``start``, -1 at the head of a text or after a break. A
        position no path reaches has -1.
        """
        last = [-1] * (stop + 1)
        pairs, tree, step = self.pairs, self.tree, self.step
        for j in range(start, stop):
            x = last[j] if j > start else before
            if x < 0 and j > start:
                continue
            node, k = tree.get(s[j]), j + 1
            if (node is None or "" not in node) and last[k] < 0:
                y = self.width + ord(s[j])
                if x < 0 or step(x, y):
                    last[k] = y
            while node is not None:
                if last[k] < 0 and "" in node:
                    y = node[""]
                    if x < 0:
                        last[k] = y
                    else:
                        free = pairs.get(x << 32 | y)
                        if step(x, y) if free is None else free:
                            last[k] = y
                if k >= stop:
                    break
                node = node.get(s[k])
                k += 1
        return last

    def walk(self, last: list[int], start: int, stop: int) -> list[int]:
        """Pieces of the path from ``start`` to ``stop``, read backwards."""
        out = []
        while stop > start:
            out.append(last[stop])
            stop -= len(self.name(last[stop]))
        return out[::-1]

    def numbers(self, pieces: list[int]) -> tuple[int, ...]:
        """Ids of pieces, bytes for characters without one."""
        if max(pieces, default=0) < self.width:
            return tuple(pieces)
        return tuple(k for p in pieces for k in (
            (p,) if p < self.width else [self.bytes[b] for b in chr(p - self.width).encode("utf-8", "surrogatepass")]))

    def path(self, s: str) -> tuple[int, ...]:
        """Ids of a text between two breaks.

        Follows the one path of weight 0, longest pieces first. As all paths of weight 0 that reach a
        position end in the same piece there, a position that leads no further is left for good.
        """
        n, ends, taken, options, dead = len(s), [0], [], [self.at(s, 0)], set()
        pairs, x, j = self.pairs, -1, 0
        while j < n:
            here = options[-1]
            while here:
                y, end = here.pop()
                if end in dead:
                    continue
                if x >= 0:
                    free = pairs.get(x << 32 | y)
                    if not (self.step(x, y) if free is None else free):
                        continue
                x, j = y, end
                taken.append(y)
                ends.append(end)
                options.append(self.at(s, j) if j < n else [])
                break
            else:
                dead.add(j)
                options.pop()
                taken.pop()
                ends.pop()
                j, x = ends[-1], taken[-1] if taken else -1
        return self.numbers(taken)

    def encode(self, s: str) -> np.ndarray:
        """Ids of an escaped text, or of a part of one between two breaks."""
        if len(self.units) > CACHE:
            self.older_units, self.units = self.units, {}
        units, known, older = self.unit.findall(s), self.units, self.older_units
        for u in units:
            if u not in known:
                known[u] = older.get(u) or array("i", self.path(u)).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, units)), np.int32)

    def encode_text(self, text: str) -> np.ndarray:
        """Ids of a whole text.

        Where single blanks and line ends part it, its words are looked up directly: a word after a blank
        by itself, one after a line end with that in front.
        """
        if not text:
            return np.zeros(0, np.int32)
        if (not (self.blanks_lead and self.lines_part) or text[0] in " \n" or text[-1] == " " or "  " in text
                or " \n" in text or BLANK in text):
            return self.encode(escaped(text))
        if len(self.words) > CACHE:
            self.older_words, self.words = self.words, {}
        words, known, older = text.replace("\n", " \n").split(" "), self.words, self.older_words
        for w in words:
            if w not in known:
                known[w] = older.get(w) or array("i", self.path(BLANK + w) if w[0] != "\n" else self.path("\n") + (
                    self.path(w[1:]) if w[1:] else ())).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)

    # --- chunks ------------------------------------------------------------------------------

    def states(self, s: str, cut: int) -> list[State]:
        """All pieces of ``s`` that end at or after ``cut`` and start before it: (piece, start, end), relative to it."""
        return [(y, j - cut, end - cut) for j in range(max(0, cut - self.longest), cut)
                for y, end in self.at(s, j) if end >= cut]

    def breaks(self, s: str, low: int, high: int) -> tuple[int, int] | None:
        """First and last position in [low, high] at which the lattice falls apart."""
        def free(k):
            return s[k - 1:k + 1] not in self.joins
        first = next((k for k in range(max(low, 1), high + 1) if free(k)), None)
        return None if first is None else (first, next(k for k in range(high, first - 1, -1) if free(k)))

    def transfer(self, s: str, head: int, tail: int, first: bool, final: bool) -> np.ndarray:
        """Max-plus matrix from the states at cut ``head`` to those at cut ``tail`` of ``s``.

        ``s`` reaches ``longest`` characters beyond both cuts. The first chunk has one state before it,
        the head of the text, the last one state after it, the end. Where the chunk holds a break, every
        state that reaches it leads to the same states behind.
        """
        into = [(-1, 0, 0)] if first else self.states(s, head)
        out = [(-1, 0, 0)] if final else self.states(s, tail)
        matrix = np.full((len(into), len(out)), NEVER)
        gap = self.breaks(s, head + self.longest, tail - self.longest)

        def reached(start: int, before: int) -> list[int]:
            last = self.scan(s, start, tail, before)
            if final:
                return [0] if last[tail] >= 0 or start == tail else []
            hit = []
            for k, (y, b, _) in enumerate(out):
                at = tail + b
                x = before if at == start else last[at] if at > start else -1
                if (at == start and x < 0) or (x >= 0 and self.step(x, y)):
                    hit.append(k)
            return hit

        after = reached(gap[1], -1) if gap else []
        for k, (x, _, e) in enumerate(into):
            if not gap:
                matrix[k, reached(head + e, x)] = 0
            elif head + e == gap[0] or self.scan(s, head + e, gap[0], x)[gap[0]] >= 0:
                matrix[k, after] = 0
        return matrix

    def chunk_ids(self, s: str, start: int, before: int, stop: int) -> np.ndarray:
        """Ids of the path from ``start``, where the piece ``before`` ends, to ``stop``, where a piece ends."""
        gap = self.breaks(s, start + 1, stop - 1) if stop - start > 1 else None
        if not gap:
            return np.array(self.numbers(self.walk(self.scan(s, start, stop, before), start, stop)), np.int32)
        first, last = gap
        head = self.numbers(self.walk(self.scan(s, start, first, before), start, first))
        tail = self.path(s[last:stop])
        return np.concatenate([np.array(head, np.int32), self.encode(s[first:last]), np.array(tail, np.int32)])


class PieceTexts:
    """What decoding needs: the bytes of every piece."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)   # only its table is read
        self.raw = pa.array([
            bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k)
            else b"" if model.is_control(k) or model.is_unknown(k)
            else model.id_to_piece(k).replace(BLANK, " ").encode() for k in range(model.get_piece_size())], pa.binary())

    def decode(self, ids: pa.ListArray) -> list[str]:
        """Texts of lists of ids; ids of control pieces stand for nothing, a null list for no ids."""
        size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.r_[0, np.cumsum(size)].astype(np.int32))
        parts = pa.ListArray.from_arrays(offsets, self.raw.take(ids.flatten()))
        found = (t.decode("utf-8", "replace") for t in pc.binary_join(parts, b"").to_pylist())
        return [t[1:] if t.startswith(" ") else t for t in found]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; associative, so chunks may be combined in any grouping."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1, initial=NEVER)


def escaped(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def load_texts(path: str) -> PieceTexts:
    return PieceTexts(path)
