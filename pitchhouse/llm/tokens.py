"""Operator 4, token counts by overlap resynchronisation, and the piece-wise
encoder that operator 8 shares.

A text up to ``chunk`` characters is one chunk and is encoded whole.  A longer text is encoded in
overlapping chunks with offsets; neighbours are spliced at a boundary that both
show and that is proven stable, and where none is found the overlap (then the
chunk) is widened.

Why a common boundary is safe.  The vocabulary's pre-tokenizer scans left to
right without looking back, merges never cross pre-tokens, and a special string
is cut out before the scan.  A boundary ``p`` of the left chunk that is followed
by another boundary and lies at least ``margin`` characters before the chunk's
end was decided on characters that the chunk holds, so the scan of the whole
text has it too.  If the right chunk also has a boundary at ``p``, then no
special string covers ``p`` and its scan from ``p`` on equals that of the whole
text.  So tokens before ``p`` count from the left chunk, those from ``p`` on from
the right one.

A text that is encoded whole is counted by units, white space and what follows it up to
the next: the byte-level scan breaks wherever white space begins, and looks no further
than the first character after it.  The library encodes each distinct unit once, as long
as it is kept.

Nulls and empty texts have 0 tokens.  Repeated rows each give a row.  The result
has the id and new columns only, so other columns of the input cannot clash.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from operator import attrgetter
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import slices, with_package

CHUNK, OVERLAP, MARGIN = 16_384, 512, 64
#: Marks at the end of a word, and the first letter beyond the Latin blocks.
MARKS, LATIN_END = ".,;:!?", "\u0250"
#: Marks that a piece-wise encoder cuts off the end of a word.
ENDS = MARKS + "#$%&*+=@~^/|\\()[]{}<>\"-_"
#: The first character beyond Latin, Greek, Cyrillic and Armenian.
LETTERS_END = 0x590
#: Pieces that an encoder keeps from one slice to the next.
CACHE = 500_000
#: Pieces joined to one string, pieces and whole texts given to the library at a time.
JOINED, BATCH_PIECES, BATCH_TEXTS = 256, 1 << 14, 64
#: White space and what follows; what is white space to Python alone, or to older libraries.
UNIT, UNSURE = re.compile(r"\s*\S+|\s+"), re.compile("[\x1c-\x1f\u180e]")
#: Units that a counter keeps in each of two generations, and the longest one kept.
UNITS, LONGEST = 200_000, 64

ID = attrgetter("id")

_loaded: dict = {}


def tokenizer(path: str):
    """The library's tokenizer, once in each Python process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def library_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceEncoder:
    """Ids of many pieces; the library encodes each distinct piece once, as long as
    it is kept.

    Many pieces are encoded as one string, with a special token of the vocabulary
    between them: it is cut out before the text is normalised and split, so its id
    shows where one piece ends.  A piece that holds a character with which a special
    token starts is encoded by itself.

    Where the vocabulary ignores the case of ASCII letters and cuts marks off a word,
    a piece's ids are those of its core (in lower case if ASCII), then of the marks at its
    end: only cores and marks that are new go to the library.  A core of letters
    that the normaliser and the splitter leave as they are goes to the library's model
    straight away."""

    def __init__(self, path: str, keep: int = CACHE):
        self.tok, self.keep = tokenizer(path), keep
        special = {i: t.content for i, t in self.tok.get_added_tokens_decoder().items()
                   if t.special and not (t.lstrip or t.rstrip or t.single_word)}
        self.between, self.mark = next(iter(sorted(special.items())), (None, None))
        starts = {t.content[:1] for t in self.tok.get_added_tokens_decoder().values()}
        self.alone = re.compile("[" + re.escape("".join(sorted(starts))) + "]") if starts else None
        folds = self.tok.normalizer is not None and self.tok.normalizer.normalize_str(ascii_uppercase) == ascii_lowercase
        cuts = self.tok.pre_tokenizer is not None and [x for x, _ in self.tok.pre_tokenizer.pre_tokenize_str("ab" + ENDS)] == ["ab", ENDS]
        self.parted = folds and cuts
        self.model, self.letters = self.tok.model, _letters(self.tok) if self.parted else {}
        self.word = re.compile("[" + "".join(map(chr, self.letters)) + "]+").fullmatch if self.letters else None
        self.code: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0  # the ids of all pieces, one after the other
        self.first, self.n, self.seen = (np.zeros(1 << 14, np.int64) for _ in range(3))  # their place, number, uses

    def codes(self, pieces: list[str], uses: np.ndarray | None = None) -> np.ndarray:
        """A code for each piece, valid until the next ``trim``.  ``uses``: how often each
        one stands, where ``pieces`` are distinct."""
        out = np.fromiter(map(self.code.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(out < 0).tolist()
        if unknown:
            missed = [pieces[i] for i in unknown]
            self._learn(list(dict.fromkeys(missed)))
            out[unknown] = np.fromiter(map(self.code.get, missed), np.int64, len(missed))
        if uses is not None:
            self.seen[out] += uses
        elif len(out):
            self.seen[:len(self.code)] += np.bincount(out, minlength=len(self.code))
        return out

    def _learn(self, new: list[str]) -> None:
        joined, rest = new, []
        if not self.mark:
            joined, rest = rest, joined
        elif self.alone and self.alone.search("".join(new)):
            joined, rest = [], []
            for p in new:
                (rest if self.alone.search(p) else joined).append(p)
        if self.parted:
            self._compose(joined)
        else:
            self._encode(joined, [])
        self._encode([], rest)

    def _compose(self, new: list[str]) -> None:
        """Learn ``new`` from their cores and marks."""
        lower = [p.lower() if p.isascii() else p for p in new]
        bare = [p.rstrip(ENDS) for p in lower]
        plain, own, parts = [], [], []
        for p, core, word in zip(new, lower, bare):
            if p == word:  # its own core
                plain.append(p)
            # other letters may become a letter and a combining sign, which goes with the marks
            elif word and word[-1] < LATIN_END and word[-1].isalpha() and len(word[-1].lower()) == 1:
                own.append(p)
                parts += (word, core[len(word):])
            elif p == core:
                plain.append(p)
            else:
                own.append(p)
                parts += (core, "")
        known = self.code
        self._encode([p for p in dict.fromkeys(chain(plain, parts)) if p and p not in known], [])
        if own:
            code = np.fromiter(map(known.get, parts, repeat(-1)), np.int64, len(parts)).reshape(-1, 2)
            code = code[fresh := np.fromiter((p not in known for p in own), bool, len(own))].ravel()
            size, first = np.where(code < 0, 0, self.n[code]), self.first[code]
            run = np.cumsum(size) - size
            ids = self.flat[np.repeat(first - run, size) + np.arange(int(size.sum()))]
            self._put([p for p, k in zip(own, fresh.tolist()) if k], ids, np.cumsum(size)[1::2])

    def _encode(self, joined: list[str], rest: list[str]) -> None:
        """Learn pieces from the library: many to a string, and one by one."""
        if self.word:
            words, every, joined = [], joined, []
            for p in every:
                (words if (p.isascii() and p.isalpha()) or self.word(p) else joined).append(p)
            for i in range(0, len(words), BATCH_PIECES):
                part = words[i:i + BATCH_PIECES]
                seen = [p if p.isascii() else p.translate(self.letters) for p in part]
                found = list(map(self.model.tokenize, seen))
                self._put(part, np.fromiter(map(ID, chain.from_iterable(found)), np.uint32), np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))
        for i in range(0, len(joined), BATCH_PIECES):
            part = joined[i:i + BATCH_PIECES]
            texts = [self.mark.join(part[k:k + JOINED]) for k in range(0, len(part), JOINED)]
            ids = np.fromiter(chain.from_iterable(
                chain(e.ids, (self.between,)) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)), np.uint32)
            ends = np.flatnonzero(ids == self.between)
            if len(ends) != len(part):
                raise ValueError("the special token does not separate pieces in this vocabulary")
            self._put(part, ids[ids != self.between], ends - np.arange(len(ends)))
        for i in range(0, len(rest), BATCH_PIECES):
            part = rest[i:i + BATCH_PIECES]
            ids = [e.ids for e in self.tok.encode_batch_fast(part, add_special_tokens=False)]
            self._put(part, np.fromiter(chain.from_iterable(ids), np.uint32), np.cumsum([len(x) for x in ids]))

    def _put(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        at, more = len(self.code), len(pieces)
        self.code.update(zip(pieces, range(at, at + more)))
        self.flat = _room(self.flat, self.used + len(ids))
        self.first, self.n, self.seen = (_room(x, at + more) for x in (self.first, self.n, self.seen))
        begins = np.append(0, ends[:-1])
        self.flat[self.used:self.used + len(ids)] = ids
        self.first[at:at + more], self.n[at:at + more] = self.used + begins, ends - begins
        self.seen[at:at + more] = 0
        self.used += len(ids)

    def trim(self) -> None:
        """Between slices: once too much is kept, forget the pieces that were used
        least, and at least half of all."""
        n = len(self.code)
        if n <= self.keep and self.used <= 8 * self.keep:
            return
        floor = max(2, int(np.partition(self.seen[:n], n // 2)[n // 2]) + 1)
        stay = self.seen[:n] >= floor
        pieces = [p for p, k in zip(self.code, stay.tolist()) if k]
        first, size = self.first[:n][stay], self.n[:n][stay]
        run = np.cumsum(size) - size
        ids = self.flat[np.repeat(first - run, size) + np.arange(int(size.sum()))]
        self.code, self.used = {}, 0
        self.flat = np.zeros(1 << 16, np.uint32)
        if pieces:
            self._put(pieces, ids, np.cumsum(size))


def _letters(tok) -> dict[int, str]:
    """Letters that the vocabulary's normaliser keeps and its splitter never takes
    apart, with what its model reads for each; none if it does not work so."""
    norm = tok.normalizer.normalize_str if tok.normalizer is not None else str
    cut, out = tok.pre_tokenizer.pre_tokenize_str, {}
    for c in map(chr, range(LETTERS_END)):
        if c.isalpha() and norm(c) == c and len(parts := cut(c)) == 1:
            out[ord(c)] = parts[0][0]
    text = "".join(map(chr, out))
    same = norm(text) == text and [x for x, _ in cut(text)] == ["".join(out.values())]
    return out if same and all(out.get(ord(c)) == c for c in ascii_lowercase) else {}


def _room(x: np.ndarray, need: int) -> np.ndarray:
    """``x`` with room for ``need`` values, doubled as often as that takes."""
    if need <= len(x):
        return x
    out = np.zeros(max(need, 2 * len(x)), x.dtype)
    out[:len(x)] = x
    return out


def encoder_of(path: str, keep: int = CACHE) -> PieceEncoder:
    """The encoder of this Python process, with the pieces of earlier tasks."""
    key = (path, "pieces")
    if key not in _loaded:
        _loaded[key] = PieceEncoder(path)
    _loaded[key].keep = keep
    _loaded[key].trim()
    return _loaded[key]


class Units:
    """Token counts of short texts: the library encodes distinct units.  Those of the
    last ``keep`` and more that were met are kept: when so many are new, the
    generation before is forgotten, but for the ones met since."""

    def __init__(self, path: str, keep: int = UNITS):
        self.tok, self.keep = tokenizer(path), keep
        self.old: dict[str, int] = {}
        self.new: dict[str, int] = {}
        pre = self.tok.pre_tokenizer
        scan = json.loads(pre.__getstate__()) if pre is not None else {}
        added = self.tok.get_added_tokens_decoder().values()
        #: whether units are independent in this vocabulary
        self.apart = (self.tok.normalizer is None and scan.get("type") == "ByteLevel" and scan.get("use_regex") is True
                      and not scan.get("add_prefix_space")
                      and not any(t.lstrip or t.rstrip or t.single_word or t.normalized or UNIT.findall(t.content) != t.content.split() for t in added))
        # a word and its marks are scanned apart, if no added token may be in them
        self.model, self.letters = self.tok.model, _letters(self.tok) if self.apart else {}
        plain = self.letters and not any(t.content[:1] in MARKS or ord(t.content[:1] or " ") in self.letters for t in added)
        cuts = plain and [x for x, _ in pre.pre_tokenize_str(" ab" + MARKS)] == [pre.pre_tokenize_str(" ")[0][0] + "ab", MARKS]
        self.word = re.compile("( ?[" + "".join(map(chr, self.letters)) + "]+)([" + MARKS + "]*)").fullmatch if cuts else None
        if cuts:
            self.letters = self.letters | {ord(" "): pre.pre_tokenize_str(" ")[0][0]}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of whole texts."""
        out = np.zeros(len(texts), np.int64)
        whole = [i for i, t in enumerate(texts) if not self.apart or UNSURE.search(t)]
        out[whole] = self._encoded([texts[i] for i in whole])
        rest = sorted(set(range(len(texts))).difference(whole))
        units = [UNIT.findall(texts[i]) for i in rest]
        upto = np.append(0, np.cumsum(self.of(list(chain.from_iterable(units)))))[np.cumsum([0, *map(len, units)])]
        out[rest] = np.diff(upto)
        return out

    def of(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit."""
        n = np.fromiter(map(self.new.get, units, repeat(-1)), np.int64, len(units))
        missed = np.flatnonzero(n < 0).tolist()
        if missed:
            words = [units[i] for i in missed]
            n[missed] = np.fromiter(map(self._learned(dict.fromkeys(words)).get, words), np.int64, len(words))
        return n

    def _learned(self, words: dict[str, None]) -> dict[str, int]:
        found: dict[str, int] = {}
        rest: list[str] = []
        for w in words:
            n = self.old.get(w)
            if n is None and self.word and (m := self.word(w)):
                n = sum(map(self._part, m.groups()))
            if n is None:
                rest.append(w)
            else:
                found[w] = n
        for k in range(0, len(rest), BATCH_PIECES):
            part = rest[k:k + BATCH_PIECES]
            found.update(zip(part, self._encoded(part)))
        self.new.update((w, n) for w, n in found.items() if len(w) <= LONGEST)
        if len(self.new) > self.keep:
            self.old, self.new = self.new, {}
        return found

    def _part(self, part: str) -> int:
        """Tokens of a word or of marks, which the model reads at once."""
        n = self.new.get(part, self.old.get(part)) if part else 0
        if n is None:
            n = len(self.model.tokenize(part if part.isascii() and part[0] != " " else part.translate(self.letters)))
            if len(part) <= LONGEST:
                self.new[part] = n
        return n


def units_of(path: str) -> Units:
    """The units of this Python process, with those of earlier tasks."""
    key = (path, "units")
    if key not in _loaded:
        _loaded[key] = Units(path)
    return _loaded[key]


class Counter:
    """Token counts of whole texts."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tok, self.chunk, self.overlap, self.units = tokenizer(path), chunk, overlap, units_of(path)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Short texts whole; huge ones chunk by chunk."""
        out = np.zeros(len(texts), np.int64)
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        for k in range(0, len(short), BATCH_TEXTS):
            part = short[k:k + BATCH_TEXTS]
            out[part] = self.units.counts([texts[i] for i in part])
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                # units as the items of a chunk, where some will start in every overlap
                by_unit = self.units.apart and not UNSURE.search(t) and max(map(len, UNIT.findall(t)[:-1]), default=len(t)) <= self.overlap // 4
                out[i] = resync_count(t, self.encode_units if by_unit else self.encode, self.chunk, self.overlap)
        return out

    def encode_units(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digests, starts, heads) of a chunk's units, and the tokens before each."""
        units = UNIT.findall(text)
        ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        before = np.append(0, np.cumsum(self.units.of(units)))
        return np.fromiter(map(hash, units), np.int64, len(units)), np.append(0, ends[:-1]), np.ones(len(units), bool), before

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start offsets, whether a pre-token starts there) of a chunk."""
        e = self.tok.encode(text, add_special_tokens=False)
        word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        starts = np.array([s for s, _ in e.offsets], np.int64)
        head = np.ones(len(word), bool)
        head[1:] = word[1:] != word[:-1]
        return np.array(e.ids, np.int64), starts, head


def resync_count(text: str, encode: Callable, chunk: int = CHUNK, overlap: int = OVERLAP,
                 margin: int = MARGIN, seen: list | None = None) -> int:
    """Tokens of ``text`` from overlapping chunks.  ``encode`` gives ids, start
    offsets and pre-token heads of a chunk, and the tokens before each item if items
    are not tokens; ``seen`` gets the splice points and the overlaps that were needed."""
    n, a, end = len(text), 0, min(chunk, len(text))
    left, skip, total = encode(text[:end]), 0, 0
    while end < n:
        width = min(overlap, end - a - 1)
        while True:
            c = end - width
            right_end = min(c + max(chunk, 2 * width), n)
            right = encode(text[c:right_end])
            found = _splice(left, right, a, c, end - margin, skip)
            if found:
                break
            if width < end - a - 1:  # alignment failed: widen the overlap
                width = min(2 * width, end - a - 1)
            else:  # the overlap is the chunk: widen the chunk itself
                end = min(end + (end - a), n)
                left = encode(text[a:end])
                if end == n:
                    return total + _tokens(left, skip, len(left[0]))
                width = min(overlap, end - a - 1)
        i, j = found
        total += _tokens(left, skip, i)
        if seen is not None:
            seen.append((int(left[1][i]) + a, width))
        a, end, left, skip = c, right_end, right, j
    return total + _tokens(left, skip, len(left[0]))


def _tokens(part, first: int, end: int) -> int:
    """Tokens of a chunk's items from ``first`` up to ``end``."""
    return int(part[3][end] - part[3][first]) if len(part) > 3 else end - first


def _splice(left, right, a: int, c: int, last: int, skip: int) -> tuple[int, int] | None:
    """Token numbers in both chunks of a boundary that both have, at most at
    ``last``, after which both have the same next pre-token."""
    i = np.flatnonzero(left[2])
    p = left[1][i] + a
    ok = np.ones(len(i), bool)
    ok[-1:] = False  # the last pre-token may go on beyond the chunk
    ok &= (p >= c) & (p <= last) & (i >= skip)
    j = np.flatnonzero(right[2])
    common, li, rj = np.intersect1d(p[ok], right[1][j] + c, return_indices=True)
    for k in range(len(common) // 2, len(common)):
        x, y = i[ok][li[k]], j[rj[k]]
        nx = i[np.searchsorted(i, x, "right")]
        same = left[0][x:nx]
        if np.array_equal(same, right[0][y:y + len(same)]):
            return int(x), int(y)
    return None


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: id, UTF-8 bytes, tokens, whether they are over
    ``limit``.  No shuffle: every text is counted where it is read."""
    with_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, chunk, overlap)
        for _, texts, part in slices(batches, 1):
            n = counter.counts(texts)
            yield pa.record_batch([part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                   pa.array(n, pa.int64()), pa.array(n > limit)],
                                  names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
