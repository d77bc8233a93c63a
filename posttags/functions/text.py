"""Column expressions on text: splitting posts, tokens, stopwords, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

SPLITTER = ">>>"

# Spark's default English stopwords, as StopWordsRemover loads them.
ENGLISH_STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
    wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
    that's there's what's when's where's who's why's would
    """.split()
)


def body_of(line: Column) -> Column:
    """Text before the first splitter."""
    return F.get(F.split(line, SPLITTER), F.lit(0))


def tag_text_of(line: Column) -> Column:
    """Second field; NULL on a line without a splitter. Later fields are ignored."""
    return F.get(F.split(line, SPLITTER), F.lit(1))


def words_of(text: Column, unicode_blanks: bool = False) -> Column:
    """Split on blanks; case kept, no empty words."""
    pattern = r"(?U)\s+" if unicode_blanks else r"\s+"
    return F.filter(F.split(text, pattern), lambda word: word != "")


def drop_words(words: Column, unwanted: Sequence[str]) -> Column:
    """Case-sensitive removal; the kept words stay in order with their repeats."""
    if not unwanted:
        return words
    return F.filter(words, lambda word: ~word.isin(*unwanted))


def primary_tag(tags: Column) -> Column:
    return F.get(tags, F.lit(0))


def any_shared(left: Column, right: Column) -> Column:
    """1 if the two tag lists overlap, else 0."""
    return F.coalesce(F.arrays_overlap(left, right).cast("int"), F.lit(0))


def md5_number(value: Column) -> Column:
    """First 32 bits of the MD5 digest as a bigint, the same on every engine."""
    digest = F.md5(value.cast("string"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def md5_bucket(value: Column, buckets: int) -> Column:
    return md5_number(value) % F.lit(buckets)
