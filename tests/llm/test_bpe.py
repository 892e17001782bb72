import hashlib
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docloom.llm import bpe
from docloom.llm.packing import LibraryCodec

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "Hello <|endoftext|> World's it'S we'Ll", "ΑΣ ΟΔΟΣ, ß İstanbul é ① ½ ٣ a\x1cb​c 　x \xa0 中文字 👍🏽 don't",
    "<|startoftext|>", "x<|endoftext|><|endoftext|>y <|end", "\x00\x01 ﬁ Ⅷ", "'S 's ''s", "ǅ Ω", "été", " \n\t ", "a" * 5000, " x\x85y",
]


def texts():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCéèüñß0123456789.,!?'#-_ \n"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(300)]


def test_ids_and_text_equal_the_library():
    library, own = Tokenizer.from_file(PATH), bpe.Codec(PATH)
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert array("I", got).tolist() == want, text
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_every_character_equals_the_library():
    """All code points, among letters and digits: those that Python's tables lack one by one, the others in blocks."""
    library = Tokenizer.from_file(PATH)
    coders = bpe.Codec(PATH), LibraryCodec(PATH)
    newer = coders[0].newer
    assert newer
    known = [c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff" and c not in newer]
    blocks = [known[i : i + 500] for i in range(0, len(known), 500)]
    for block in [*blocks, *([c] for c in sorted(newer))]:
        text = " ".join([f"a{c}B1{c}2 {c}" for c in block])
        want = library.encode(text, add_special_tokens=False).ids
        for coder in coders[: 1 + (len(block) == 1)]:
            assert array("I", coder.encode(text)).tolist() == want, block[0]


def test_store_of_words_may_overflow(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    small, own = bpe.Codec(PATH), bpe.Codec(PATH)
    for text in texts():
        assert small.encode(text) == own.encode(text)


def test_tasks_get_the_newer_characters_and_each_run_is_found_once(monkeypatch):
    own = bpe.Codec(PATH)
    monkeypatch.setattr(bpe, "newer_characters", lambda: pytest.fail("looked for again"))
    for kind in (bpe.Codec, LibraryCodec):
        coder, found = kind(PATH, own.newer), []
        plain = coder.words.find
        coder.words.find = lambda run: found.append(run) or plain(run)
        odd = min(own.newer)
        for text in [*texts(), f"same {odd} words", "same words", f"same {odd} words", *texts()]:
            assert coder.encode(text) == own.encode(text)
        stored = [run for run in found if not own.has_newer(run)]
        assert len(stored) == len(set(stored)) and set(stored) == set(coder.words)


def test_stale_entries_are_skipped():
    ranks = {("a", "b"): 0, ("b", "a"): 1, ("ab", "ab"): 2, ("ab", "a"): 3}
    assert bpe.merge_word(list("ababa"), ranks) == ["abab", "a"]
    assert bpe.merge_word(["a"], ranks) == ["a"]
    assert bpe.merge_word(list("bbb"), ranks) == list("bbb")


def test_documents(spark):
    rows = [(i, t, 1) for i, t in enumerate(texts())] + [(None, None, 2), (0, "again", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(4)
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.digest_round_trip(docs, PATH).collect()), key=repr) == sorted(want, key=repr)
    assert {(r["doc_id"], len(r["ids"]) // 4) for r in bpe.encode_documents(docs, PATH).collect()} == {w[:2] for w in want}
    assert bpe.digest_round_trip(docs.limit(0), PATH).count() == 0


def test_unknown_ids_fail():
    with pytest.raises(KeyError):
        bpe.Codec(PATH).decode(array("I", [10**6]).tobytes())
