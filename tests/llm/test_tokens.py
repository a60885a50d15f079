import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchhouse.llm import simple8b, tokens

from tests.llm.conftest import prose

BYTES, WORDS = tokens.library_path("byte_bpe_50k.json"), tokens.library_path("word_bpe_49k.json")


def library(path: str, text) -> list[int]:
    return tokens.tokenizer(path).encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n\n", " x　y", "<|endoftext|>", "a<|endoftext|> b", "x <|endoftext|>y",
       "it's we'll I'D", "12 345 6", "!! ?? ...", "é ß 漢字 😀‍👩", "a\tb\r\nc", "[UNK] [CLS] <pad> <s> </s>", "́ x́ İ"]


def test_counts_of_odd_texts():
    texts = ODD + [a + b for a in ODD for b in ODD]
    got = tokens.Counter(BYTES).counts(texts)
    assert got.tolist() == [len(library(BYTES, t)) for t in texts]


def test_resynchronised_counts_of_long_texts():
    rng = random.Random(8)
    for i in range(30):
        text = "".join(rng.choice([prose(i, 20), " ", "   ", "\n", "漢字", "aaaaaaaaaaaaaaaaaaaaaa", "<|endoftext|>", "12345", "'s"])
                       for _ in range(40))
        counter = tokens.Counter(BYTES, chunk=200, overlap=20)
        assert counter.counts([text])[0] == len(library(BYTES, text)), text


def test_overlap_is_widened_where_nothing_aligns():
    text, seen = "a" * 3000 + " tail of words " + "9" * 2000 + " " * 1500 + "end", []
    counter = tokens.Counter(BYTES)
    got = tokens.resync_count(text, counter.encode, 400, 40, 16, seen)
    assert got == len(library(BYTES, text))
    words, seen = prose(3, 4000), []
    assert tokens.resync_count(words, counter.encode, 400, 100, 16, seen) == len(library(BYTES, words))
    assert len(seen) > 20


def test_token_counts(docs, texts, odd, nothing):
    got = tokens.token_counts(docs, BYTES).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library(BYTES, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)
    assert tokens.token_counts(nothing, BYTES).collect() == []
    assert tokens.token_counts(odd, BYTES).count() == 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1) | st.integers(0, 70_000) | st.just(0), max_size=3000))
def test_simple8b_round_trip(ids):
    v = np.array(ids, np.uint64)
    words, first, escaped = simple8b.encode_words(v)
    assert simple8b.decode_words(words, first, len(v), escaped).tolist() == ids
    image = simple8b.pack([None, 7], np.array([0, len(ids)]), v)
    docs, counts, back = simple8b.unpack(image)
    assert docs == [None, 7] and counts.tolist() == [0, len(ids)] and back.tolist() == ids


def test_blocks_decode_one_by_one():
    v = np.arange(5000, dtype=np.uint64) % 977
    words, first, escaped = simple8b.encode_words(v)
    ends = [*first[1:].tolist(), len(words)]
    for b, (lo, hi) in enumerate(zip(first.tolist(), ends)):
        want = v[b * simple8b.BLOCK:(b + 1) * simple8b.BLOCK]
        assert simple8b.decode_words(words[lo:hi], np.array([0]), len(want), escaped).tolist() == want.tolist()


def test_ids_of_odd_texts():
    counts, flat = simple8b._ids_of(tokens.PieceEncoder(WORDS), ODD, 1)
    ends = np.cumsum(counts)
    for t, a, b in zip(ODD, ends - counts, ends):
        assert flat[a:b].tolist() == library(WORDS, t) + [1], repr(t)


def test_joined_pieces_and_trimming():
    """Pieces joined by a special token, those that hold one, and an encoder that
    forgets: always the library's ids."""
    rng = random.Random(4)
    encoder = tokens.PieceEncoder(WORDS, keep=40)
    alphabet = ["a", "B", "é", "́", "ß", "漢", "1", "'s", "!", "<", "<|", "|>", "startoftext", "<|startoftext|>", "<|endoftext|>", "　", "😀"]
    for _ in range(60):
        texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 30)))
                 for _ in range(4)]
        counts, flat = simple8b._ids_of(encoder, texts, 1)
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends):
            assert flat[a:b].tolist() == library(WORDS, t) + [1], repr(t)
        encoder.trim()
        assert len(encoder.code) <= 40


def test_token_files(docs, texts, nothing):
    start = 0
    got = sorted(simple8b.token_files(docs, WORDS).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == list(range(len(texts)))
    for r in got:
        ids = library(WORDS, texts[r.doc_id]) + [1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert simple8b.token_files(nothing, WORDS).collect() == []


def test_token_files_of_odd_rows(odd):
    got = simple8b.token_files(odd, WORDS).collect()
    assert sorted(r.start for r in got)[0] == 0 and len(got) == 5
    first = min(got, key=lambda r: r.start)
    assert first.doc_id is None  # a null id comes first


@pytest.mark.parametrize("n", [1, 3, 16])
def test_partitions_change_nothing(docs, tmp_dir, n):
    simple8b.write_ids(docs, WORDS, f"{tmp_dir}/ids", partitions=n)
    got = sorted(map(tuple, simple8b.read_ids(docs.sparkSession, f"{tmp_dir}/ids").collect()))
    assert got == sorted(map(tuple, simple8b.token_files(docs, WORDS).collect()))


def test_cores_and_marks():
    """Pieces put together from a core and the marks at its end have the library's ids,
    also where the normaliser changes the core's last letter."""
    rng = random.Random(6)
    encoder = tokens.PieceEncoder(WORDS)
    assert encoder.parted
    alphabet = ["a", "B", "Cd", "é", "É", "T̈", "ẗ", "क़", "İ", "1", "'s", "'S", ".", ",", "?!", "<", "漢", "́", "Å"]
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 5))) + rng.choice(["", ".", ",", "...", "?!;:"]) for _ in range(6000)]
    for at in range(0, len(pieces), 700):  # pieces, cores and marks learned before or in the same call
        part = pieces[at:at + 700]
        for p, c in zip(part, encoder.codes(part)):
            assert encoder.flat[encoder.first[c]:encoder.first[c] + encoder.n[c]].tolist() == library(WORDS, p), repr(p)


def test_selectors_against_plain_packing():
    """Every word holds as many ids as the fullest selector that fits."""
    rng = random.Random(9)
    for n in (1, 59, 1023, 1024, 1025, 5000):
        ids = [rng.choice([0, 0, 1, 3, 200, 999, 48_000, 70_000, 1 << 40, 1 << 62]) if rng.random() < 0.2 else rng.choice([0, 1])
               for _ in range(n)]
        got, _, escaped = simple8b.encode_words(np.array(ids, np.uint64))
        want, out = [], []
        for b in range(0, n, simple8b.BLOCK):
            rest = ids[b:b + simple8b.BLOCK]
            while rest:
                for s in (15, *range(1, 15), 0):
                    head = rest[:simple8b.COUNTS[s]]
                    if not s or max(head) < 1 << int(simple8b.WIDTHS[s]):
                        break
                if s:
                    want.append(s << 60 | sum(v << k * int(simple8b.WIDTHS[s]) for k, v in enumerate(head)))
                else:
                    want.append(len(out))
                    out.append(head[0])
                rest = rest[len(head):]
        assert got.tolist() == want and escaped.tolist() == out


class Watched:
    """A tokenizer that notes how many characters its whole way of encoding was given."""

    def __init__(self, path: str):
        self.tok, self.given = tokens.tokenizer(path), 0

    def __getattr__(self, name):
        return getattr(self.tok, name)

    def encode_batch_fast(self, texts, **how):
        self.given += sum(map(len, texts))
        return self.tok.encode_batch_fast(texts, **how)

    def encode(self, text, **how):
        self.given += len(text)
        return self.tok.encode(text, **how)


SPACED = ["a  b\t\n c<|endoftext|>d <|endoftext|> x.. y,<|endo", "x\x1cy !\x1c z", " ", "\n\n", "a  b's it's ' s", "z  ", "", "a b  c ᠎ d",
       "\x85 q\x85r", "don't STOP... ,;now !?", "café naïve текст, σοφός. é 你好", "word " * 5000,
       "\n\n  word,  other" * 2000, "x" * 20000, "ab<|endoftext|> " * 1500, "one\x1ctwo " * 2500]


@pytest.mark.parametrize("keep", [3, 200_000])
def test_units_count_as_whole_texts(keep):
    counter = tokens.Counter(BYTES)
    counter.units = tokens.Units(BYTES, keep)
    assert counter.units.apart and counter.units.word
    for _ in range(2):
        assert counter.counts(SPACED).tolist() == [len(library(BYTES, t)) for t in SPACED]
    assert len(counter.units.new) <= keep + 200 or keep > 3


def test_the_library_sees_repeated_text_once(monkeypatch):
    texts = ["some words, that come again and again. " * k for k in (5, 50, 800)]
    want, watched = [len(library(BYTES, t)) for t in texts], Watched(BYTES)
    monkeypatch.setattr(tokens, "tokenizer", lambda path: watched)
    monkeypatch.setattr(tokens, "_loaded", {})
    assert tokens.Counter(BYTES).counts(texts).tolist() == want
    assert watched.given < 200


def test_words_of_letters_go_to_the_model(monkeypatch):
    pieces = [f"{a}{b}" for a in ("wort", "été", "текст", "σοφός") for b in ("abend", "ola", ",", "")]
    want, watched = [library(WORDS, p) for p in pieces], Watched(WORDS)
    monkeypatch.setattr(tokens, "tokenizer", lambda path: watched)
    encoder = tokens.PieceEncoder(WORDS)
    codes = encoder.codes(pieces)
    got = [encoder.flat[encoder.first[c]:encoder.first[c] + encoder.n[c]].tolist() for c in codes]
    assert got == want
    assert watched.given < 60


def test_repeated_words_are_looked_up_once():
    texts = ["a b\ta\r\nb  a", "", " \n", "b a!! c", "c"]
    encoder, asked = tokens.PieceEncoder(WORDS), []
    codes = encoder.codes
    encoder.codes = lambda pieces, *uses: asked.append(list(pieces)) or codes(pieces, *uses)
    counts, flat = simple8b._ids_of(encoder, texts, 1)
    assert sorted(asked[0]) == ["a", "a!!", "b", "c"] and len(asked) == 1
    assert encoder.seen[encoder.code["a"]] == 3 and encoder.seen[encoder.code["a!!"]] == 1
    want = [[*tokens.tokenizer(WORDS).encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert counts.tolist() == [len(x) for x in want] and flat.tolist() == sum(want, [])
