"""SentencePiece encoding and decoding by streaming Viterbi.

The best split of a text maximises the sum of the pieces' scores. Text is read once, left
to right; a boundary further back than the longest piece cannot be extended any more, so
only that many boundaries survive. Whenever the backpointers of all survivors meet in one
boundary, the ids before it are final and leave memory. A character that no piece covers is
spelt in byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: The mark that stands for a space.
MARK = "▁"
#: Words whose ids a worker remembers (two generations of so many), and the longest it remembers.
MEMORY, LONGEST = 200_000, 40
#: Characters of a text that enter the window at once.
PART = 4096
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary of a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.known = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
        self.longest = max(map(len, self.known), default=1)
        self.bytes = {int(model.id_to_piece(i)[3:-1], 16): i for i in ids if model.is_byte(i)}
        self.spelt = [b""] * len(ids)  # what each id stands for
        for piece, (i, _) in self.known.items():
            self.spelt[i] = piece.replace(MARK, " ").encode()
        for value, i in self.bytes.items():
            self.spelt[i] = bytes([value])
        self.unknown = min((s for _, s in self.known.values()), default=0.0) - 10.0
        #: If no piece has the mark after another character, a word's end is always a boundary.
        self.by_word = all(MARK not in p.lstrip(MARK) for p in self.known)

    @cached_property
    def trie(self) -> ahocorasick.Automaton:
        """Pieces as a trie that finds all that end at each character of a text, the longest first,
        in one walk; a piece stands for its length, id and score."""
        found = ahocorasick.Automaton()
        for piece, (i, score) in self.known.items():
            found.add_word(piece, (len(piece), i, score))
        found.make_automaton()
        return found

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "replace")]


#: Stands for a character that no piece covers: its length, no id, no score.
_SPELT = (1, -1, 0.0)


class StreamingViterbi:
    """Feed marked text in parts; each call returns the ids that have become final.

    Text is read once, left to right, as the trie reports the pieces that end at each boundary. Among
    equal sums the longest last piece wins; a character is spelt in bytes only where no piece ends. All
    paths converge at a boundary that no piece crosses; it is final once the longest piece has passed it.
    Where every boundary is crossed, the backpointers of the last `longest` boundaries are followed until
    they meet. What stays in memory is a part and the window behind it."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._restart()

    def _restart(self) -> None:
        self.text = ""  # from the last final boundary
        self.score, self.last = [0.0], [_SPELT]  # by boundary: best sum, its last piece
        self.cuts: list[int] = []  # boundaries that no piece crosses so far

    def feed(self, part: str) -> list[int]:
        return [i for _, ids in self.spans(part) for i in ids]

    def finish(self) -> list[int]:
        return [i for _, ids in self.last_spans() for i in ids]

    def spans(self, part: str) -> list[tuple[int, list[int]]]:
        """What has become final, from one boundary of convergence to the next: characters and ids."""
        self._read(part)
        longest, n = self.pieces.longest, len(self.text)
        ends = [c for c in self.cuts if c <= n + 1 - longest]
        if not ends and n >= 4 * longest:
            meet = self._meeting(n)
            ends = [meet] if meet else []
        return self._cut_off(ends)

    def last_spans(self) -> list[tuple[int, list[int]]]:
        """What is left when the text ends; the next text may follow."""
        out = self._cut_off(self.cuts)
        self._restart()
        return out

    def _read(self, part: str) -> None:
        """Best last piece of every boundary of a part."""
        score, last, cuts, unknown = self.score, self.last, self.cuts, self.pieces.unknown
        n = len(score)
        done = n - 1
        # The walk starts so far back that no piece that ends in the part is missed.
        behind = self.text[max(0, len(self.text) - self.pieces.longest + 1) :]
        shift = 1 + len(self.text) - len(behind)
        if self.pieces.known:
            for end, piece in self.pieces.trie.iter(behind + part):
                end += shift
                if end <= done:
                    continue
                begin = end - piece[0]
                if n <= end:
                    while n < end:  # no piece ends here
                        score.append(score[-1] + unknown)
                        last.append(_SPELT)
                        cuts.append(n)
                        n += 1
                    score.append(score[begin] + piece[2])
                    last.append(piece)
                    n += 1
                    while cuts and cuts[-1] > begin:
                        cuts.pop()
                    cuts.append(end)
                elif (offer := score[begin] + piece[2]) > score[end]:
                    score[end], last[end] = offer, piece
        self.text += part
        while n <= len(self.text):
            score.append(score[-1] + unknown)
            last.append(_SPELT)
            cuts.append(n)
            n += 1

    def _cut_off(self, ends: list[int]) -> list[tuple[int, list[int]]]:
        """Ids between final boundaries; what lies before the last one leaves memory."""
        out, first = [], 0
        for end in ends:
            out.append((end - first, self._path(end, first)))
            first = end
        if first:
            base = self.score[first]
            self.text = self.text[first:]
            self.score = [s - base for s in self.score[first:]]
            self.last = self.last[first:]
            self.cuts = [c - first for c in self.cuts if c > first]
        return out

    def _meeting(self, at: int) -> int:
        """The boundary where the paths of all that may still be extended meet."""
        alive = set(range(max(0, at + 1 - self.pieces.longest), at + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(max(last - self.last[last][0], 0))
        return alive.pop()

    def _path(self, end: int, first: int) -> list[int]:
        steps: list[int] = []
        while end > first:
            size, piece, _ = self.last[end]
            if piece >= 0:
                steps.append(piece)
            else:
                steps += reversed(self.pieces.fallback(self.text[end - 1]))
            end -= size
        steps.reverse()
        return steps


class Codec:
    """Encodes and decodes whole texts.

    A text streams through one window in parts of bounded size. Where no piece of the model crosses the
    end of a word, all paths converge there; ids between two such boundaries are remembered by their
    text, so a word met again is not solved again. The memory is a shortcut: ids are the same without it."""

    def __init__(self, path: str, remember: bool = True):
        self.pieces = Pieces(path)
        self.window = StreamingViterbi(self.pieces)
        self.remember = remember and self.pieces.by_word
        self.fresh: dict[str, bytes] = {}  # two generations, so that frequent words stay
        self.stale: dict[str, bytes] = {}

    def stream(self, parts: Iterable[str]) -> Iterator[int]:
        """Ids of one text given in parts, as they become final."""
        first = True
        for part in parts:
            yield from self.window.feed((MARK if first else "") + part.replace(" ", MARK))
            first = False
        yield from self.window.finish()

    def _learn(self, words: list[str]) -> None:
        """Stream words one after the other and remember the ids of each; only the last may end in a mark."""
        text, ends = "".join(words), iter(words)
        word, size, ids = next(ends), 0, []
        for begin in range(0, len(text), PART):
            spans = self.window.spans(text[begin : begin + PART])
            if begin + PART >= len(text):
                spans += self.window.last_spans()
            for n, found in spans:
                size, ids = size + n, ids + found
                if size == len(word):  # every word ends where all paths converge
                    self.fresh[word] = np.array(ids, "<u4").tobytes()
                    word, size, ids = next(ends, ""), 0, []

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit bytes; none for an empty text."""
        if not text:
            return b""
        if not self.remember:
            parts = (text[at : at + PART] for at in range(0, len(text), PART))
            return np.fromiter(self.stream(parts), "<u4").tobytes()
        words = _WORD.findall(MARK + text.replace(" ", MARK))
        if len(self.fresh) >= MEMORY:
            self.stale, self.fresh = self.fresh, {}
        fresh, stale, new = self.fresh, self.stale, []
        for word in dict.fromkeys(words):
            if word not in fresh:
                if word in stale:
                    fresh[word] = stale[word]
                else:
                    new.append(word)
        if new:
            self._learn(new)
        out = b"".join(map(fresh.__getitem__, words))
        for word in new:
            if len(word) > LONGEST:
                del fresh[word]
        return out

    def decode(self, ids: bytes) -> str:
        spelt = self.pieces.spelt
        text = b"".join([spelt[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    """One codec a worker process, so that its memory outlives a task."""
    return Codec(path)


def _mapped(docs: DataFrame, read: str, new: str, kind: str, path: str, each) -> DataFrame:
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.schema.fields if f.name != new)}, {new} {kind}"
    arrow = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = pa.array([each(codec, v) for v in part.column(read).to_pylist()], arrow)
                names = [n for n in part.schema.names if n != new]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), made], names=[*names, new])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """Every row with the ids of its whole text (little-endian 32-bit).

    A missing text has missing ids, an empty one none. A column named like the new one is replaced.
    """
    return _mapped(docs, text, ids, "binary", path or model_path(), lambda c, t: None if t is None else c.encode(t))


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", text: str = "text") -> DataFrame:
    """Every row with the text of its ids; the text comes back as it was, unless it held the
    mark itself, which reads as a space. Missing ids give a missing text."""
    return _mapped(rows, ids, text, "string", path or model_path(), lambda c, b: None if b is None else c.decode(b))
