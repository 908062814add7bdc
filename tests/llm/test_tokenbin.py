import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from surveyloom.llm import tokenbin
from surveyloom.llm.frames import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n\t ", "Hello, World. It's it 's 12345", "é e\u0301 ́x Σας ΣΑΣ", "a<|endoftext|>b <|startoftext|>", "\x01 a\x01b \x1cq",
         "word. word, word; WORD WORD! ...,", "x" * 5000 + ".", "日本語テキスト 한국어", "tab\tand\u00a0nbsp\u2003em", "a " * 40_000, "don't 've"]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=60)), "<u4")
    packed = tokenbin.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    first = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - first))
    assert tokenbin.unpack(packed, bits, first, count).tolist() == ids[first:first + count].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé'.,! \n\t1\x01\u0301ΣK<|>endoftx", max_size=40), max_size=8))
def test_encoder_is_the_tokenizer(texts):
    with open(PATH, encoding="utf-8") as file:
        encode = tokenbin.encoder(file.read())
    plain = Tokenizer.from_file(PATH)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def written(spark, documents):
    rows = [(None if i == 4 else i * 7 % 23, t, "s") for i, t in enumerate(TEXTS)] + [(0, "again", "s"), (0, "again", "s")]
    path = new_path(spark, "tokens-test")
    tokenbin.write_tokens(documents(rows), path, PATH)
    plain = Tokenizer.from_file(PATH)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    return path, [(i, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, _ in rows]


def test_documents_come_back(spark, written):
    path, want = written
    at, expected = 0, []
    for i, ids in want:
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    assert sorted(map(tuple, tokenbin.token_table(spark, path).collect()), key=lambda r: r[1]) == expected
    rows = tokenbin.read_tokens(spark, path).collect()
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == sorted((str(i), ids) for i, ids in want)


def test_any_range_comes_back(spark, written):
    path, want = written
    all_ids = [x for _, ids in want for x in ids]
    index = tokenbin.block_index(spark, path)
    for first, count in ((0, 5), (7, 1000), (len(all_ids) - 3, 3), (0, len(all_ids)), (5, 0)):
        assert tokenbin.token_range(index, first, count).tolist() == all_ids[first:first + count]


def test_no_documents(spark, documents):
    path = new_path(spark, "tokens-test")
    tokenbin.write_tokens(documents([]), path, PATH)
    assert tokenbin.token_table(spark, path).count() == 0


def same_ids(path, texts):
    with open(path, encoding="utf-8") as file:
        encode = tokenbin.Encoder(file.read())
    plain = Tokenizer.from_file(path)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(st.text(max_size=6), st.sampled_from([*".,;:!?", " ", "\n", "İ", "ς", "क़", "שׁ", "̇"])),
                         max_size=12).map("".join), max_size=4))
def test_encoder_on_all_of_unicode(texts):
    same_ids(PATH, texts)


def test_closing_marks_after_every_letter():
    """Whatever a letter becomes by composing and lowering, a mark after it is split as the tokenizer splits it."""
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    rare = [c for c in letters if not 0x3400 <= ord(c) < 0xD7A4 and ord(c) < 0x17000]
    same_ids(PATH, ["ADALETİ, dedi", "İ?", "cİ:", *(f"x{c}. {c}, {c}{c}!" for c in rare)])


def test_other_tokenizers_get_whole_texts():
    with open(PATH, encoding="utf-8") as file:
        assert tokenbin.drops_blanks(file.read())
    other = public_tokenizers.path("byte_bpe_50k.json")
    with open(other, encoding="utf-8") as file:
        assert not tokenbin.drops_blanks(file.read())
    same_ids(other, [t or "" for t in TEXTS])


def test_files_are_read_by_many_tasks(spark, documents, monkeypatch):
    """Names of files are few bytes, which adaptive execution would merge into one task."""
    monkeypatch.setattr(tokenbin, "BLOCK_IDS", 4)
    monkeypatch.setattr(tokenbin, "BLOCKS_PER_FILE", 1)
    path = new_path(spark, "tokens-test")
    tokenbin.write_tokens(documents([(i, f"text {i}", "s") for i in range(300)]), path, PATH)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    rows = tokenbin.read_tokens(spark, path).selectExpr("spark_partition_id() AS task", "path").distinct().collect()
    assert len({r["path"] for r in rows}) >= 280 and len({r["task"] for r in rows}) > 100
    assert tokenbin.token_table(spark, path).count() == 300


def test_plain_letters_skip_the_steps_that_leave_them(monkeypatch):
    """Only what is not a run of plain letters goes through the whole tokenizer, and of marks each run once."""
    with open(PATH, encoding="utf-8") as file:
        encode = tokenbin.Encoder(file.read())
    asked, whole = [], encode._encode
    monkeypatch.setattr(encode, "_encode", lambda words: asked.extend(words) or whole(words))
    encode.together(["Straße, Été! naïf### plain", "été! WORD### word, Ærø"])
    assert sorted(asked) == ["!", "###", ","]
    letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
    marks = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
    same_ids(PATH, [f"{c} x{c} {c}y {c * 3}, x{c}{c}#%" for c in letters])
    same_ids(PATH, [f"a{m} é{m}{m} a,{m} a{m}. a{m}s {m}a a{m}é" for m in marks])


def test_only_known_steps_are_skipped():
    with open(PATH, encoding="utf-8") as file:
        spec = file.read()
    assert tokenbin.keeps_letters(spec)
    for old, new in (("[\\\\p{L}]+", "[\\\\p{L}]"), ('"use_regex":false', '"use_regex":true'), ('"content":" "', '"content":"e"')):
        changed = json.dumps(json.loads(spec), ensure_ascii=False, separators=(",", ":")).replace(old, new)
        assert changed.count(new) and not tokenbin.keeps_letters(changed)
        Tokenizer.from_str(changed)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=9)), max_size=12))
def test_texts_are_grouped_by_bytes(texts):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokenbin, "GROUP", 8)
        found = list(tokenbin.groups(pa.array(texts, pa.string())))
    assert [i for a, b in found for i in range(a, b)] == list(range(len(texts)))
    sizes = [len((t or "").encode()) for t in texts]
    assert all(a < b and sum(sizes[a:b - 1]) < 8 for a, b in found)
    assert all(sum(sizes[a:b]) >= 8 for a, b in found[:-1])


def test_words_are_forgotten_between_groups_only(monkeypatch):
    monkeypatch.setattr(tokenbin, "REMEMBERED", 3)
    with open(PATH, encoding="utf-8") as file:
        encode = tokenbin.Encoder(file.read())
    plain = Tokenizer.from_file(PATH)
    texts = ["one two, three", "two, four #5 don't", "", "one two, Three###", "three### #5 six. Ω. ω."] * 3
    found = [x for a in range(0, 15, 2) for x in encode.together(texts[a:a + 2])]
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
