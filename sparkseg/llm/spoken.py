"""Spoken words of a transcript: without time marks, sound annotations, labels and hesitations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseg.functions.columns import collapsed, let
from sparkseg.functions.speakers import label_key

_CLOCK = r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
#: Time marks: [00:01:02], <00:01:02.345>, (01:02), [62s], 00:01:02,345 --> 00:01:04,000 and 00:01:02.345 |.
TIME = rf"(?:[\[<(]\s*(?:{_CLOCK}|\d+(?:\.\d+)?\s*s)\s*[\]>)]|\d{{1,3}}:\d{{2}}:\d{{2}}[.,]\d{{1,3}}(?:\s*-->\s*\d{{1,3}}:\d{{2}}:\d{{2}}[.,]\d{{1,3}})?\s*\|?)"
#: Sound annotations: whatever is in brackets, between stars or notes, however long.
SOUND = r"(?:\(\([^()]*\)\)|\[[^\[\]]*\]|\([^()]*\)|<[^<>]*>|\{[^{}]*\}|（[^（）]*）|【[^【】]*】|\*[^*\s][^*\n]*\*|♪[^♪\n]*♪|♪)"

_NUMBERED = r"(?:speaker|spkr|spk|s)[\s._#-]*"
#: A numbered label at the beginning of a text; the number is its group.
NUMBER_LABEL = rf"(?i)^(?:>>\s*)?(?:[\[(<]\s*(?={_NUMBERED}\d+\s*[\])>]))?{_NUMBERED}0*(\d{{1,18}})\s*(?:[\])>]\s*:?|[:–—|]|-\s)\s*"
_PART = r"\p{L}[\p{L}\p{M}'’.-]*+"
#: What may be a name used as a label there; it is one if the recording has it.
NAME_LABEL = rf"^(?:>>\s*)?[\[<]?\s*({_PART}(?: {_PART}){{0,3}})\s*(?:[\]>]\s*:?|[:–—：]|-\s)\s*"

# fixed values: hesitation sounds
HESITATIONS = [
    *"uh uhm uhh umm hmm hm mm mmm mhm erm ehm err ahm".split(),
    *"eh ehh ehhh eeh mmh euh euuh heu hum ahn hã äh ähm öh öhm hem éé".split(),
    *"음 어 으음 에 음음".split(),
    *"э эм ммм мм э-э ээ эээ".split(),
    *"امم آآ ممم إممم اممم".split(),
    *"उम्म अम्म हम्म म अं ऊँ".split(),
]
# fixed values: hesitation sounds that are also words of another language (German and Portuguese um, Portuguese em)
ALSO_WORDS = "um em er".split()
# fixed values: hesitation sounds of languages written without spaces
UNSPACED = "えーと えっと うーん あのー ええと んー".split()
UNSPACED_BEFORE_MARK = "嗯 呃 额 唔 啊".split()

_EDGE = r"[\p{L}\p{M}\p{N}'’]"
_TAIL = r"(?:\.{2,}|[,…،、，。.])*"


def _spaced(words: list[str], tail: str) -> str:
    return rf"(?iu)(?<!{_EDGE})(?:{'|'.join(sorted(words, key=len, reverse=True))})(?!{_EDGE}){tail}"


_HESITATION = rf"{_spaced(HESITATIONS, _TAIL)}|(?:{'|'.join(UNSPACED)}){_TAIL}|(?:{'|'.join(UNSPACED_BEFORE_MARK)})(?:(?:\.{{2,}}|[,…、，.])+|(?=\s|$))|(?<=^|\s)(?:{'|'.join(UNSPACED_BEFORE_MARK)})。"
#: The doubtful ones count as hesitations where a mark of hesitation follows.
_DOUBTFUL = _spaced(ALSO_WORDS, r"(?:\.{2,}|[,…])+")
_DOUBTFUL_ALONE = _spaced(ALSO_WORDS, "")


def beginning(text: Column) -> Column:
    """The text from behind leading time marks on."""
    return F.regexp_replace(text, rf"^(?:\s|{TIME})+", "")


def leading_number(at: Column) -> Column:
    """Number of the numbered label that a text begins with, else null."""
    digits = F.regexp_extract(at, NUMBER_LABEL, 1)
    return F.when(digits != "", digits.cast("bigint"))


def leading_name(at: Column) -> Column:
    """Key of what may be a name used as a label at the beginning, else null."""
    name = F.regexp_extract(at, NAME_LABEL, 1)
    return F.when(name != "", label_key(name))


def unmarked(text: Column) -> Column:
    """The text without time marks and sound annotations."""
    return F.when(text.rlike(r"[\[(<{（【*♪]|\d:\d"), F.regexp_replace(F.regexp_replace(text, TIME, " "), SOUND, " ")).otherwise(text)


def speech(text: Column) -> Column:
    """The text without marks and hesitations, in single spaces."""
    calm = F.regexp_replace(F.regexp_replace(unmarked(text), _HESITATION, " "), _DOUBTFUL, " ")
    return collapsed(F.regexp_replace(calm, r"(?:^|\s)[\s,，、|>-]+(?=\s|$)", " "))


# fixed values: frequent words that tell English and Spanish texts, where um and em are hesitations, from others
_ENGLISH = r"(?iu)(?<!\p{L})(?:the|and|we|you|they|that|this|was|is|it|of|to|she|he)(?!\p{L})"
_SPANISH = r"(?iu)(?<!\p{L})(?:el|los|las|una|que|del|y|la|es)(?!\p{L})"


def _settled(spoken: Column) -> Column:
    english, spanish = _spaced(["um", "er"], _TAIL), _spaced(["em"], _TAIL)

    def cleaned(x: Column) -> Column:
        return F.when(x.rlike(_ENGLISH), F.regexp_replace(x, english, " ")).when(x.rlike(_SPANISH), F.regexp_replace(x, spanish, " ")).otherwise(x)

    return let(spoken, cleaned)


def clean(spoken: Column) -> Column:
    """``speech`` without the doubtful hesitations that the text's language doesn't have as words."""
    return collapsed(_settled(spoken))


#: The beginning of a word that is no hesitation.
_WORD = rf"(?iu)(?<!{_EDGE})(?!(?:{'|'.join(sorted(HESITATIONS + ALSO_WORDS, key=len, reverse=True))})(?!{_EDGE}))[\p{{L}}\p{{N}}]"
_ANY_UNSPACED = rf"[{''.join(sorted({w[0] for w in UNSPACED + UNSPACED_BEFORE_MARK}))}]"


def has_words(text: Column) -> Column:
    """Whether a text has a letter or digit besides marks and hesitations, doubtful ones included."""
    calm = let(unmarked(text), lambda bare: F.when(bare.rlike(_ANY_UNSPACED), F.regexp_replace(bare, _HESITATION, " ")).otherwise(bare))
    return F.coalesce(calm.rlike(_WORD), F.lit(False))


#: The spaced hesitations, looked for where a word begins with one of their letters.
_QUICK = _spaced(HESITATIONS, _TAIL).replace("(?:", f"(?=[{''.join(sorted({w[0] for w in HESITATIONS}))}])(?:", 1)


def heard(text: Column) -> Column:
    """The words of ``clean(speech(text))``, with its white space and stray marks left as they are, at half the cost."""

    def calm(bare: Column) -> Column:
        return F.when(bare.rlike(_ANY_UNSPACED), F.regexp_replace(bare, _HESITATION, " ")).otherwise(F.regexp_replace(bare, _QUICK, " "))

    def told(x: Column) -> Column:
        return F.when(x.rlike(_DOUBTFUL_ALONE), _settled(F.regexp_replace(x, _DOUBTFUL, " "))).otherwise(x)

    return let(let(unmarked(text), calm), told)


def with_speech(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``lead_number``, ``lead_name``, ``body`` and ``body_named``.

    ``body_named`` is the text behind its label if ``lead_name`` is a name of the recording,
    ``body`` is it otherwise. Null and blank texts have no label and null or blank bodies.
    """
    at, number, name = F.col("__at"), F.col("lead_number"), F.col("lead_name")
    return (
        df.withColumn("__at", beginning(F.col(text)))
        .withColumn("lead_number", leading_number(at))
        .withColumn("lead_name", F.when(number.isNull(), leading_name(at)))
        .withColumn("body", F.when(number.isNotNull(), F.regexp_replace(at, NUMBER_LABEL, "")).otherwise(at))
        .withColumn("body_named", F.when(name.isNotNull(), F.regexp_replace(at, NAME_LABEL, "")).otherwise(F.col("body")))
        .drop("__at")
    )
