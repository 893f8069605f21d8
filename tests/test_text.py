"""Text expressions against the known answers and a plain Python restatement."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterloom.functions import text as T
from meterloom.operators import corpus


def values(spark, texts, *columns):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "i int, text string").repartition(3)
    return [tuple(r)[1:] for r in sorted(df.select("i", *columns).collect())]


def plain_normalize(text):
    text = unicodedata.normalize("NFC", text).replace("\r\n", "\n").replace("\r", "\n")
    text = "".join(" " if c.isspace() and c != "\n" else c for c in text)
    while "  " in text:
        text = text.replace("  ", " ")
    while "\n\n\n" in text:
        text = text.replace("\n\n\n", "\n\n")
    return "\n".join(part.strip() for part in text.split("\n")).strip()


def plain_key(text):
    text = unicodedata.normalize("NFC", text).lower()
    kept = [c for c in text if c == "_" or unicodedata.category(c)[0] in "LN"]
    return hashlib.sha1("".join(kept).encode()).hexdigest()


def plain_repetition(text):
    words = text.split()
    return max(words.count(w) for w in words) / len(words) if len(words) >= 4 else 0.0


def plain_ratio(text):
    letters = [c for c in text if re.match(r"[^\W\d_]", c)]
    hangul = [c for c in letters if re.match("[가-힣ᄀ-ᇿ㄰-㆏]", c)]
    return len(hangul) / len(letters) if letters else 0.0


PIECES = [
    "가", "가", "각", "한국어", "é", "Å", "क़", "ﬁ",
    "a", "a", "a", "B", "Zz", "_", "1", "½", "Ⅷ", "༳", "٣", ".", "!?", "’", "日本", "が",
    " ", "  ", "\t", "　", "\xa0", "\x1c", "\x1f", "\x85", " ", "​", " ",
    "\n", "\n\n\n\n", "\r\n", "\r", "\n \n", " \n", "😀", "̀", "ㄱ",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    made = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(600)]
    words = ["네", "b", "cc"]
    made += [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(200)]
    return made


def test_normalisation_matches_python(spark, texts):
    got = values(spark, texts, T.normalize_text(F.col("text")))
    assert [g[0] for g in got] == [plain_normalize(t) for t in texts]


def test_script_ratio_matches_python(spark, texts):
    got = values(spark, texts, T.script_ratio(F.col("text")))
    assert [g[0] for g in got] == pytest.approx([plain_ratio(t) for t in texts])


def test_dedup_key_matches_python(spark, texts):
    got = values(spark, texts, T.dedup_key(F.col("text")))
    assert [g[0] for g in got] == [plain_key(t) for t in texts]


def test_repetition_matches_python(spark, texts):
    text = F.col("text")
    columns = [T.repetition_ratio(text)] + [T.is_repetitive(text, m) for m in (0.3, 0.5, 0.75)]
    got = values(spark, texts, *columns)
    ratios = [plain_repetition(t) for t in texts]
    assert [g[0] for g in got] == pytest.approx(ratios)
    for place, limit in ((1, 0.3), (2, 0.5), (3, 0.75)):
        assert [g[place] for g in got] == [r > limit for r in ratios]


def test_nothing_outside_the_suspects_changes_under_composition():
    suspect = re.compile("[̀-‏ -꯿힤-\U0010ffff]")
    # Everything that is ever the second half of a composition, or a mark, must be suspect.
    seconds = set()
    for point in range(0x110000):
        char = chr(point)
        if 0xD800 <= point < 0xE000:
            continue
        parts = unicodedata.decomposition(char)
        if parts and not parts.startswith("<") and len(parts.split()) == 2:
            seconds.add(chr(int(parts.split()[1], 16)))
        if not suspect.match(char):
            assert unicodedata.normalize("NFC", char) == char
            assert unicodedata.combining(char) == 0
    assert all(suspect.match(c) for c in seconds)


@pytest.mark.parametrize(
    ("text", "expected"),
    [("한국어 test", 3 / 7), ("안녕!!!   ???", 1.0), ("한글 123", 1.0), ("", 0.0), ("hello world", 0.0)],
)
def test_known_ratios(spark, text, expected):
    assert values(spark, [text], T.script_ratio(F.col("text")))[0][0] == pytest.approx(expected)


def test_one_pass_keeps_what_a_second_would_shorten(spark):
    once = values(spark, ["a\n \n \nb"], T.normalize_text(F.col("text")))[0][0]
    assert once == "a\n\n\nb"
    assert values(spark, [once], T.normalize_text(F.col("text")))[0][0] == "a\n\nb"


def test_equal_keys_across_layout_form_and_punctuation(spark):
    variants = ["가 나다.", "가나 다", " 가나다!! ", "가\n나　다"]
    assert len(set(values(spark, variants, T.dedup_key(F.col("text"))))) == 1


def test_length_counts_code_points(spark):
    assert values(spark, ["가나", "😀"], T.length_chars(F.col("text"))) == [(2,), (1,)]


LONG = "한국어로 쓴 충분히 긴 답변입니다 예시"


@pytest.mark.parametrize(
    ("instruction", "output", "reasons"),
    [
        ("질문입니다", LONG, []),
        ("", "", ["empty_instruction", "empty_output"]),
        (None, LONG, ["empty_instruction"]),
        ("질문입니다", " \n ", ["empty_output"]),
        ("질문입니다", "짧다", ["output_too_short"]),
        ("a question", "a long english answer here", ["not_korean"]),
        (LONG, LONG + ".", ["output_echoes_instruction"]),
        ("질문입니다", "네 " * 200, ["repetitive"]),
        ("q", "q", ["output_too_short", "not_korean", "output_echoes_instruction"]),
    ],
)
def test_reasons(spark, instruction, output, reasons):
    rows = spark.createDataFrame(
        [(1, instruction, "", output, "s")],
        "row_id long, instruction string, input string, output string, source string",
    )
    assert corpus.score(rows).first()["reasons"] == reasons


def test_threshold_is_a_parameter(spark):
    rows = spark.createDataFrame(
        [(1, "한국", "", "mixed 한국어 latin text", "s")],
        "row_id long, instruction string, input string, output string, source string",
    )
    assert corpus.score(rows, min_ratio=0.1).first()["reasons"] == []
    assert corpus.score(rows, min_ratio=0.9).first()["reasons"] == ["not_korean"]


def test_a_low_repeat_limit_uses_the_exact_ratio(spark):
    rows = spark.createDataFrame(
        [(1, "질문", "", "가 가 나 다 라 마 바 사", "s")],
        "row_id long, instruction string, input string, output string, source string",
    )
    assert corpus.score(rows, max_repeat_ratio=0.2).first()["reasons"] == ["repetitive"]
    assert corpus.score(rows, max_repeat_ratio=0.25).first()["reasons"] == []


def test_every_character_that_composition_may_change_is_suspected():
    """Over all of Unicode: what changes, combines, or stands second in a composed character."""
    import sys

    coarse = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", T.NFC_SUSPECT) + "]")
    fine = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", T.NFC_SUSPECT_FINE) + "]")
    second = set(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))
    for code in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(chr(int(parts[1], 16)))
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if unicodedata.combining(c) or c in second or unicodedata.normalize("NFC", c) != c:
            assert coarse.match(c) and fine.match(c), hex(code)
    for text in ("漢字とかなカナ、。「」", "中文文本，没有变化。", "ＡＢＣ１２", "한국어 문장입니다."):
        assert not fine.search(text)
    assert fine.search("\u304b\u3099") and fine.search("\u1100\u1161")


def test_composition_holds_few_texts_as_strings():
    texts = pa.array(["e\u0301 " * 2000, None] * 1000)
    tracemalloc.start()
    found = T._compose.func(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == ["\xe9 " * 2000, None] * 1000
    assert peak < 2 << 20  # all of them are over 12 MB
