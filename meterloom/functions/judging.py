"""Judge prompts and judge scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.functions.text import SPACE, is_blank, strip

DEFAULT_MAX_SCORE = 10

# The score forms a judge may answer in, tried in this order.
BRACKETED_SCORE = rf"\[\[[{SPACE}]*([0-9]+(?:\.[0-9]+)?)[{SPACE}]*\]\]"
LABELLED_SCORE = (
    rf"(?i)(?:최종[{SPACE}]*)?(?:점수|평점|score|rating)[{SPACE}]*[:：]?"
    rf"[{SPACE}]*([0-9]+(?:\.[0-9]+)?)"
)
BARE_NUMBER = r"\A([0-9]+(?:\.[0-9]+)?)\z"

# The prompt the judge is asked with.
PROMPT_OPENING = (
    "당신은 한국어 답변의 품질을 평가하는 심사위원입니다.\n"
    "정확성, 논리성, 한국어 표현의 자연스러움을 함께 고려하여 평가하세요.\n"
)
PROMPT_QUESTION = "[질문]"
PROMPT_ANSWER = "[답변]"
PROMPT_REFERENCE = "[참고 답안]"
PROMPT_CLOSING = (
    "먼저 평가 근거를 2~3문장으로 쓰고, 마지막 줄에 1점부터 {max_score}점 사이의\n"
    "점수를 반드시 [[점수]] 형식으로 출력하세요. 예: [[7]]"
)


def judge_prompt(
    question: Column, answer: Column, reference: Column, max_score: int = DEFAULT_MAX_SCORE
) -> Column:
    """The prompt for one answer. An empty reference leaves its block out."""
    reference_block = F.when(
        F.coalesce(reference, F.lit("")) != "",
        F.concat(F.lit(f"{PROMPT_REFERENCE}\n"), reference, F.lit("\n")),
    )
    return F.concat_ws(
        "\n",
        F.lit(PROMPT_OPENING),
        F.concat(F.lit(f"{PROMPT_QUESTION}\n"), question, F.lit("\n")),
        F.concat(F.lit(f"{PROMPT_ANSWER}\n"), answer, F.lit("\n")),
        reference_block,
        F.lit(PROMPT_CLOSING.format(max_score=max_score)),
    )


def _last_match(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.try_element_at(found, F.lit(-1)).cast("double")


def stated_score(text: Column) -> Column:
    """P10: the number the judge committed to, in range or not; null if there is none.

    Bracketed beats labelled beats a text that is nothing but a number. Judges restate
    the scale before concluding, so the last match of a form is the verdict.
    """
    return F.coalesce(
        _last_match(text, BRACKETED_SCORE),
        _last_match(text, LABELLED_SCORE),
        _last_match(strip(text), BARE_NUMBER),
    )


def parse_score(text: Column, max_score: int = DEFAULT_MAX_SCORE) -> Column:
    """``struct<score, error>``; an unusable judgement has a null score."""
    stated = stated_score(text)
    head = F.concat(F.lit("'"), F.substring(text, 1, 120), F.lit("'"))
    valid = stated.between(1, max_score)
    error = (
        F.when(is_blank(text), F.lit("empty judge response"))
        .when(stated.isNull(), F.concat(F.lit("no score found in judge response: "), head))
        .when(
            ~valid,
            F.concat(
                F.lit("score "),
                stated.cast("string"),
                F.lit(f" outside 1..{max_score} in judge response: "),
                head,
            ),
        )
        .otherwise(F.lit(""))
    )
    return F.struct(F.when(valid, stated).alias("score"), error.alias("error"))
