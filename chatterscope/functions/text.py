"""Text to token and phrase arrays, as built-in column expressions only.

The steps, each usable alone:

    normalize_text -> tokenize
    normalize_text -> sentence_tokens -> strip_punctuation -> phrase_words -> ngrams

Sentences are kept flat: a sentence break is the token ``BREAK`` inside one array, so that no
nested arrays are built.  ``phrase_words`` turns breaks and stop words into NULL, and an n-gram
that touches a NULL is NULL itself, hence windows never cross either of them.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterscope import constants as C

BREAK = "\x01"
TAIL = "\x02"

_WORD = r"\p{L}\p{N}_"
_SPACE = r" \t\n\x0B\f\r"
WHITE_SPACE = " \t\n\x0b\f\r"

# What the lower-cased text is searched for, in this order.  The look-around parts
# keep the link pattern linear: a host can only begin where its run of host characters begins,
# and must hold a dot.
URL = (
    r"(?:href=)?[(\[]?(?:http?://)?(?<![\da-z.\-])(?=[\da-z\-]*+\.)"
    r"[\da-z.\-]+\.[a-z.]{2,6}[/\w.\-]*[)\]]?"
)
URL_HINT = r"\.[a-z.]{2}"
SHORT_URL = r"[(\[]?http://(?:bit\.ly|t\.co|lnkd\.in|tcrn\.ch)\S*\b[)\]]?"
WHOLE_NUMBER = r"^[0-9]+(?:[,.][0-9]+)?(\n?)\z"
# what a text must hold, the pattern, its replacement
ENTITIES = (
    ("&gt", r"&gt;?", "<"),
    ("&amp", r"&amp;?", "&"),
    ("&quot", r"&quot;?", C.IMAGE_MARK),
    ("&tilde", r"&tilde;?", "~"),
    ("&mdash", r"&mdash;?", "-"),
    ("&", r"&\w;", C.HTML_MARK),
)
UNICODE_ESCAPE = r"\\u[0-9a-f]{4}"
IMAGE = r"<img[^>]*[^/]>"

PLAIN_TOKEN = rf"[{_WORD}]+|[{_SPACE}]+|,+|[{{}}\-<>=]+|[^{_WORD}{_SPACE}']"

# A sentence ends at .?! (with closing quotes or brackets) after two word characters when white
# space follows, and at the end of the text.
SENTENCE_END = rf"([.?!])(?<=[{_WORD}]'?[{_WORD}]'?[.?!])([.?!']*[\"')\]]*)[{_SPACE}]+"
TEXT_END_RUN = r"([.?!])([.?!']*[\"')\]]*)\z"
# The last raw word of a text without closing punctuation stands alone ("don't" -> don, t).
TEXT_END_WORD = rf"(?<![{_WORD}])([{_WORD}]+'*)\z"

# Adjacent pieces without space between them form one token (3.14, mr.), ASCII punctuation other
# than .?! stands alone.
GLUED_TOKEN = (
    rf"[^{_SPACE}\"#$%&()*+,\-/:;<=>@\[\\\]^`{{|}}~{BREAK}{TAIL}]+"
    rf"|{BREAK}|{TAIL}[^{BREAK}{TAIL}]+"
    r"|,+|[{}\-<>=]+|[\"#$%&()*+/:;@\[\\\]^`|~]"
)


def stopword_set(words: Sequence[str] = tuple(C.ENGLISH_STOP_WORDS)) -> list[str]:
    """Stop words: the given list and the single letters a-z."""
    return list(dict.fromkeys([*words, *string.ascii_lowercase]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def _where(
    text: Column, present: Callable[[Column], Column], change: Callable[[Column], Column]
) -> Column:
    """Apply a costly change only to texts that hold what it looks for."""
    return _let(text, lambda t: F.when(present(t), change(t)).otherwise(t))


def _replace_urls(text: Column) -> Column:
    """No link holds a space, so only the pieces that may be one are searched."""

    def replaced(piece: Column) -> Column:
        may_be = F.contains(piece, F.lit(".")) & piece.rlike(URL_HINT)
        return F.when(may_be, F.regexp_replace(piece, URL, C.URL_MARK)).otherwise(piece)

    return F.array_join(F.transform(F.split(text, " ", -1), replaced), " ")


def normalize_text(text: Column) -> Column:
    """Lower-case and replace links, entities, images and escapes by placeholders."""

    def holds(mark: str) -> Callable[[Column], Column]:
        return lambda t: F.contains(t, F.lit(mark))

    text = _where(F.lower(text), lambda t: t.rlike(URL_HINT), _replace_urls)
    text = _where(
        text, holds("http://"), lambda t: F.regexp_replace(t, SHORT_URL, C.SHORT_URL_MARK)
    )
    text = _where(
        text,
        lambda t: F.left(t, F.lit(1)).between("0", "9"),
        lambda t: F.regexp_replace(t, WHOLE_NUMBER, C.NUMBER_MARK + "$1"),
    )

    def entities(t: Column) -> Column:
        return reduce(
            lambda col, e: _where(col, holds(e[0]), lambda c: F.regexp_replace(c, e[1], e[2])), ENTITIES, t
        )

    text = _where(text, holds("&"), entities)
    text = _where(text, holds("\\u"), lambda t: F.regexp_replace(t, UNICODE_ESCAPE, ""))
    return _where(text, holds("<img"), lambda t: F.regexp_replace(t, IMAGE, C.IMAGE_MARK))


def tokenize(text: Column) -> Column:
    """Words, white space runs, comma runs, brace/dash runs and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(PLAIN_TOKEN), F.lit(0))


def _mark_sentences(normalized: Column, keep_tail: bool) -> Column:
    mark = f"{TAIL}$1$2{BREAK}" if keep_tail else BREAK
    text = F.replace(F.replace(normalized, F.lit(BREAK)), F.lit(TAIL))
    text = F.rtrim(text, F.lit(WHITE_SPACE))
    text = F.regexp_replace(text, SENTENCE_END, mark)

    def mark_end(chunk: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(chunk, TEXT_END_RUN, mark), TEXT_END_WORD, " $1")

    # what closes the text lies in its last chunk without a space
    text = _let(
        text,
        lambda t: _let(
            F.substring_index(t, " ", -1),
            lambda last: F.concat(
                F.left(t, F.length(t) - F.length(last)), mark_end(last)
            ),
        ),
    )
    return F.replace(text, F.lit("'"))


def sentence_tokens(normalized: Column) -> Column:
    """Flat token array; ``BREAK`` stands between sentences, closing .?! runs are left out."""
    return F.regexp_extract_all(
        _mark_sentences(normalized, keep_tail=False), F.lit(GLUED_TOKEN), F.lit(0)
    )


def marked_tokens(marked: Column) -> Column:
    """Flat token array of a text whose sentences already end with ``BREAK``."""
    return F.regexp_extract_all(F.replace(marked, F.lit("'")), F.lit(GLUED_TOKEN), F.lit(0))


def segment_sentences(normalized: Column) -> Column:
    """Array of sentences, each an array of tokens, with the closing punctuation as tokens."""
    sentences = F.filter(
        F.split(_mark_sentences(normalized, keep_tail=True), BREAK), lambda s: F.trim(s) != ""
    )

    def tokens(sentence: Column) -> Column:
        found = F.regexp_extract_all(sentence, F.lit(GLUED_TOKEN), F.lit(0))
        return F.flatten(
            F.transform(
                found,
                lambda t: F.when(
                    t.startswith(TAIL), F.split(F.substring(t, 2, 1 << 30), "")
                ).otherwise(F.array(t)),
            )
        )

    return F.transform(sentences, tokens)


def strip_punctuation(tokens: Column) -> Column:
    """Drop tokens that are part of the punctuation string."""
    return F.filter(tokens, lambda t: ~F.lit(C.PUNCTUATION).contains(t))


def phrase_words(tokens: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Tokens with sentence breaks and stop words turned into NULL barriers."""
    barriers = [BREAK, *(stopword_set() if stop_words is None else stop_words)]
    return F.transform(tokens, lambda t: F.when(~t.isin(barriers), t))


def extend_ngrams(shorter: Column, words: Column, n: int) -> Column:
    """Windows of n words from those of n - 1: each followed by the word after it."""
    following = F.slice(words, n, F.size(words))
    return F.zip_with(shorter, following, lambda a, b: F.concat(a, F.lit(" "), b))


def ngrams(words: Column, n: int) -> Column:
    """All windows of n words as strings; NULL where a window touches a barrier.

    ``words`` is used n times, so give it as a column of an earlier select, not as an expression.
    """
    grams = words
    for length in range(2, n + 1):
        grams = extend_ngrams(grams, words, length)
    return grams


def is_counted(n: Column, ngram: Column) -> Column:
    """Windows without barrier; single words need more than one character."""
    return ngram.isNotNull() & ((n > 1) | (F.length(ngram) > 1))


def contains_any(tokens: Column, terms: Sequence[Sequence[str]]) -> Column:
    """Whether a token array holds all words of any of the terms."""
    single = sorted({t[0] for t in terms if len(t) == 1})
    several = [list(t) for t in terms if len(t) > 1]
    found = F.arrays_overlap(tokens, F.lit(single)) if single else F.lit(False)
    if several:
        all_of = F.array(*map(F.lit, several))
        found = found | F.exists(all_of, lambda t: F.size(F.array_except(t, tokens)) == 0)
    return found
