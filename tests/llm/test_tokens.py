import hashlib
import zlib

import numpy as np
import pytest
from awkward import document_rows, documents
from tokenizers import Tokenizer

from barlake.llm import idfiles, tokens
from barlake.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


CASES = ["", " ", "Hello  world's İ ΑΣ café 12 !!<|endoftext|>x <|startoftext|><|endoftext|>, y.",
         "ùe eee123abc 日本 \U0001F600 \x00\x1c\x1d \x85 ﬁ Å é ʼn's 'S I'M don'T H̱ ẖ", "a" * 3000, "ab" * 2000 + "é" * 999,
         "thre###, thre*** (this), '''x's' a.b.c <|end <||> |>", "<|STARTOFTEXT|> <|startoftext|>."]


def test_codec_equals_library(library):
    codec = tokens.Codec(vocabulary())
    for text in [*CASES, *CASES, *[r[1] or "" for r in document_rows()]]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode([10 ** 6, 320]) == "a</w>"


def test_scan_equals_heap():
    codec = tokens.Codec(vocabulary())
    text = "thentherethenthatandthenthisandthat" * 5
    parts = [codec.vocab[c] for c in text[:-1]] + [codec.vocab[text[-1] + "</w>"]]
    assert codec.merge_long(list(parts)) == codec.merge(list(text))


def test_cache_generations_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 3)
    codec = tokens.Codec(vocabulary())
    for text in [*CASES, *CASES]:
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def changed_letters():
    import unicodedata
    every = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    return [c for c in every if not c.isspace() and (unicodedata.normalize("NFC", c) != c or c.lower() != c)]


@pytest.mark.parametrize("form", ["{}.", "ab{}, x", "{}\u0301!", "İ{}#", "É{}. é, ×. ÷, ß; ª.", "{}'S. {}<|endoftext|>."])
def test_letters_that_the_normaliser_changes_before_punctuation(library, form):
    """All such letters at once: one text, so that a wrong cut of one piece shows."""
    letters = changed_letters()
    assert len(letters) > 2_000 and "İ" in letters and "\u0958" in letters
    text = " ".join(form.replace("{}", c) for c in letters) + " BELEDİYESİ. İSTANBUL'DAKİ, bir ŞEHRİ. TÜRKİYE"
    want = library.encode(text, add_special_tokens=False).ids
    assert tokens.Codec(vocabulary()).encode(text) == want
    assert np.frombuffer(idfiles.Library(vocabulary()).encode(text), "<u4").tolist() == want


def test_pieces_of_every_length_and_hashes_that_meet(library, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("abXY\x00é.,<|"), n)) for n in rng.integers(1, 40, 300)) for _ in range(4)]
    texts += ["." * 500 + " a" + "." * 100 + " " + "b" * 15 + "." + " " + "c" * 17 + "!"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    lib = idfiles.Library(vocabulary())
    assert [np.frombuffer(lib.encode(t), "<u4").tolist() for t in [*texts, *texts]] == [*want, *want]
    monkeypatch.setattr(tokens.words, "mix", lambda h: h & np.uint64(7))  # nearly every hash is shared
    codec = tokens.Codec(vocabulary())
    assert [codec.encode(t) for t in [*texts, *texts]] == [*want, *want]
    monkeypatch.setattr(idfiles, "NO_MARK", {**idfiles.NO_MARK})
    lib.mark = (None, None)
    lib.pieces._clear()
    assert [np.frombuffer(lib.encode(t), "<u4").tolist() for t in texts] == want


def test_null_doc_ids_and_dotted_names_spread_over_files(spark, library):
    rows = [(None if i % 3 == 0 else i, f"text {i} is here", 1) for i in range(3_000)]
    docs = spark.createDataFrame(rows, "`a.id` long, `the.text` string, doc_id int").repartition(4)
    manifest = idfiles.write_ids(docs, vocabulary(), doc_id="a.id", text="the.text")
    files = manifest.collect()
    assert sum(f.docs for f in files) == 3_000 and max(f.docs for f in files) < 1_200
    got = idfiles.read_digests(manifest).collect()
    assert sum(r.doc_id is None for r in got) == 1_000
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def test_digests_and_columns(spark, library):
    got = sorted(map(tuple, tokens.bpe_digests(documents(spark), vocabulary()).collect()), key=str)
    want = []
    for r in document_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    docs = documents(spark)
    both = tokens.bpe_decode(tokens.bpe_encode(docs, vocabulary()), vocabulary())
    assert both.columns == [*docs.columns, "ids", "decoded"]
    assert both.filter("(text is null) <> (ids is null) or (ids is null) <> (decoded is null)").count() == 0
    with pytest.raises(ValueError, match="already"):
        tokens.bpe_encode(docs, vocabulary(), out="size")
    assert tokens.bpe_digests(documents(spark, []), vocabulary()).count() == 0


def test_id_files(spark, library):
    manifest = idfiles.write_ids(documents(spark), vocabulary(), frame_bytes=4096)
    got = list(map(tuple, idfiles.read_digests(manifest).orderBy("start").collect()))
    start, want = 0, []
    for r in sorted(document_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    picked = {r.doc_id: r.ids for r in idfiles.read_documents(manifest, [4, 10]).collect()}
    assert set(picked) == {4, 10}
    assert picked[4] == [*library.encode(dict((r[0], r[1]) for r in document_rows())[4], add_special_tokens=False).ids, 1]
    empty = idfiles.write_ids(documents(spark, []), vocabulary())
    assert empty.count() == 0 and idfiles.read_digests(empty).count() == 0


def test_reader_opens_only_the_frames_it_needs_and_checks_them(spark):
    manifest = idfiles.write_ids(documents(spark).coalesce(1), vocabulary(), frame_bytes=2048)
    file = max(manifest.collect(), key=lambda r: r.ids).file
    fs, name = idfiles.open_fs(file)
    with fs.open_input_file(name) as source:
        reader = idfiles.Reader(source)
        assert len(reader.frames) > 3
        row = int(np.argmin(reader.docs[:, 1]))
        b"".join(reader.ids(row))
        assert reader.decompressed <= 2
        content = source.read_at(source.size(), 0)
    import pyarrow as pa
    broken = bytearray(content)
    at = content.rindex(idfiles.SEEK_MAGIC.to_bytes(4, "little")) - 5 - 12 * len(reader.frames)
    broken[at + 8] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        bad = idfiles.Reader(pa.BufferReader(bytes(broken)))
        for i in range(len(bad.docs)):
            list(bad.ids(i))
    import zstandard
    assert len(zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(content)) \
        == int(reader.raw[-1])  # any zstandard reader takes the file
