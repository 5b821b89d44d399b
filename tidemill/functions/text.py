"""Text functions as native columns.  Null gives '' unless a function says otherwise."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import cache, reduce
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import rules

#: White space as Python takes it: Java's Unicode class and four separators it lacks.
SPACE = r"[\s\x1c-\x1f]"
URL = r"https?://\S+|www\.\S+|\S+\.(com|org|net|co|vn|io)(/\S*)?"
#: The same matches: where a bare domain is in a word, it is found from the word's first character on, so
#: the later ones need no try.
_URL = r"https?://\S+|www\.\S+|(?<!\S)\S+\.(com|org|net|co|vn|io)(/\S*)?"
ORPHAN = "(?<!\\w)[\\^'`~\",.]+(?!\\w)"
#: The same matches: the mark is looked at before what stands before it.
_ORPHAN = "(?=[\\^'`~\",.])" + ORPHAN
#: The same matches as rules.EMOJI: letters are told by one range.
_EMOJI = rf"[\x{{24C2}}-\x{{1FAFF}}&&{rules.EMOJI.removesuffix('+')}]+"
#: The same matches: emoticons are tried where one may begin.
_EMOTICONS = rf"(?=[:=<])(?:{'|'.join(rules.EMOTICONS)})"
#: Where an emoticon of the first stage may begin: a text without any such pair has none.
_FIRST_EMOTICON = "[:=][()<>vV]"
#: All but ASCII words, white space, letters of two ranges and usual punctuation: ASCII is told by a class of its own.
_VIDEO_ODD = r"[^\x{80}-\x{10FFFF}a-zA-Z0-9_\s.,!?;:()\-/'\"]|(?=[\x{80}-\x{10FFFF}])[^\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}]"
VIDEO_URL = r"(https?://\S+)|(www\.\S+)|(\S+\.(com|org|net|edu|gov|io|co|tv|me|ly|be|gl)\S*)"
#: All but kept letters, a-z, A-Z, 0-9 and white space: ASCII is told by a class of its own.  Possessive, so that
#: long runs need no stack.
_PUNCT = rf"(?:[^\x{{80}}-\x{{10FFFF}}a-zA-Z0-9\x09-\x0d\x1c-\x20]|(?=[\x{{80}}-\x{{10FFFF}}])[^{rules.KEPT_LETTERS}\s])++"


def rx(pattern: str, icase: bool = False) -> str:
    """A Java pattern with Unicode classes, and Unicode case folding where case is ignored."""
    return f"(?{'iu' if icase else ''}U){pattern}"


def quoted(literal: str) -> str:
    """A literal inside a Java pattern."""
    return re.sub(r"([\\.\[\]{}()*+\-?^$|/&#~])", r"\\\1", literal)


@cache
def cases(c: str) -> tuple[str, ...]:
    """The characters that are equal to one where case is ignored."""

    def fold(x: str) -> str:
        upper = x.upper()
        return (upper if len(upper) == 1 else x).lower()[0]

    return tuple(x for x in map(chr, range(0x10000)) if fold(x) == fold(c)) or (c,)


def literal(replacement: str) -> str:
    """A literal as a Java replacement."""
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def sub(c: Column, pattern: str, by: str = "", icase: bool = False) -> Column:
    return F.regexp_replace(c, F.lit(rx(pattern, icase)), F.lit(by))


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def only_where(c: Column, pattern: str, f: Callable[[Column], Column], icase: bool = False) -> Column:
    """f(c) where the pattern matches, else c: for chains of replacements that do nothing without a match."""
    return let(c, lambda v: F.when(v.rlike(rx(pattern, icase)), f(v)).otherwise(v))


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    import unicodedata

    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """Unicode NFC, for which there is no native function.  Null stays null.  Text without a character from
    U+0300 on is in NFC as it is, and doesn't go through Python."""
    return F.coalesce(_nfc(F.when(c.rlike(r"[^\x00-\x{2FF}]"), c)), c)


def collapse(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(sub(text(c), f"{SPACE}+", " "))


def trim(c: Column) -> Column:
    return sub(c, f"^{SPACE}+|{SPACE}+$")


def lower(c: Column) -> Column:
    return F.lower(text(c))


def strip_urls(c: Column, by: str = " ") -> Column:
    return sub(text(c), _URL, by)


def strip_giphy(c: Column, by: str = "") -> Column:
    return sub(text(c), r"media\d*\.giphy\.com", by)


def strip_tags(c: Column, by: str = " ") -> Column:
    return sub(text(c), "<[^>]+>", by)


def strip_mentions(c: Column, by: str = " ") -> Column:
    return sub(text(c), r"@[\w\._]+", by)


def strip_instagram(c: Column, by: str = "") -> Column:
    both = lambda v: sub(sub(v, r"\(\s*ig\s+[\w\._]+\s*\)", by), r"\(\s*instagram\s+[\w\._]+\s*\)", by)
    return only_where(text(c), r"\(\s*(?:ig|instagram)\s", both) if "(" not in by else both(text(c))


def strip_hashtags(c: Column, by: str = " ") -> Column:
    return sub(text(c), r"#\w+", by)


def strip_emoji(c: Column, by: str = " ") -> Column:
    return sub(text(c), _EMOJI, by)


def strip_emoticons(c: Column, by: str = " ") -> Column:
    """All in one alternation, ignoring case."""
    return sub(text(c), _EMOTICONS, by, icase=True)


def strip_first_emoticons(c: Column, by: str = "") -> Column:
    """One pattern after the other, with case.  Null stays null."""
    return only_where(c, _FIRST_EMOTICON, lambda v: reduce(lambda x, p: sub(x, p, by), rules.FIRST_EMOTICONS, v))


def strip_phrases(c: Column, phrases: Sequence[str] = rules.UI_PHRASES, by: str = " ") -> Column:
    """One phrase after the other, ignoring case, also inside words.  Most texts have none, so a text is searched
    for all of them at once; where it has one, neighbours of more than one plain word are searched for so again."""

    def any_of(own: Sequence[str]) -> str:
        least = [p for p in own if not any(q != p and q.lower() in p.lower() for q in own)]
        return f"(?=(?-i:[{''.join(map(quoted, sorted({c for p in least for c in cases(p[0])})))}]))(?:{'|'.join(map(quoted, least))})"

    each = lambda v, own: reduce(lambda x, p: sub(x, quoted(p), by, icase=True), own, v)

    def groups(v: Column) -> Column:
        for plain, own in groupby(phrases, lambda p: p.isascii() and p.isalpha()):
            own = tuple(own)
            v = each(v, own) if plain else only_where(v, any_of(own), lambda x, own=own: each(x, own), icase=True)
        return v

    return only_where(text(c), any_of(phrases), groups, icase=True) if phrases else text(c)


def orphan_punct(c: Column, by: str = " ") -> Column:
    return sub(text(c), _ORPHAN, by)


def squeeze(c: Column) -> Column:
    """Three or more of one letter, ignoring case, to its first twice."""
    return F.regexp_replace(text(c), F.lit(r"(?iu)(\p{L})\1{2,}"), F.lit("$1$1"))


def lexicon_order(entries: Iterable[tuple[str, str]]) -> list[tuple[str, str, bool]]:
    """(slang, standard, whether it is a word) in the order they apply: mixed, pure marks, words; each by
    falling escaped length."""
    lists: tuple[list, list, list] = ([], [], [])
    for slang, standard in entries:
        pure, mixed = re.fullmatch(r"[^\w\s]+", slang), re.search(r"[^\w\s]", slang) and re.search(r"\w", slang)
        kind = 1 if pure else 0 if mixed else 2
        lists[kind].append((slang, standard, kind == 2))
    return [x for own in lists for x in sorted(own, key=lambda x: -len(re.escape(x[0])))]


def lexicon_patterns(entries: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """The same as Java patterns and replacements."""
    return [(rf"\b{quoted(slang)}\b" if word else quoted(slang), literal(standard)) for slang, standard, word in lexicon_order(entries)]


def lexical(c: Column, entries: Iterable[tuple[str, str]]) -> Column:
    """Rewrites by an ordered lexicon, each entry on the output of those before it, ignoring case.
    Replacements are literal.  Null stays null.  One pass an entry: for large lexicons see
    lexicon.rewritten(), which gives the same."""
    return reduce(lambda x, e: sub(x, e[0], e[1], icase=True), lexicon_patterns(entries), c)


def strip_punct(c: Column) -> Column:
    """Keeps letters of the table, a-z, A-Z, 0-9 and white space; the rest is one space."""
    return collapse(sub(text(c), _PUNCT, " "))


def denoise(c: Column) -> Column:
    """The final stage's second step: URLs, tags, mentions, hashtags, page furniture, stray marks."""
    return collapse(orphan_punct(strip_phrases(strip_hashtags(strip_mentions(strip_tags(strip_urls(c)))))))


def seven_step(c: Column, lexicon: Iterable[tuple[str, str]] = (), normalise: bool = False) -> Column:
    """The final stage's cleaning: lower case (after NFC if asked), emoji and emoticons, furniture,
    squeeze, lexicon, punctuation, white space."""
    x = lower(nfc(c) if normalise else c)
    x = denoise(collapse(strip_emoticons(strip_emoji(x))))
    return collapse(strip_punct(lexical(squeeze(x), lexicon)))


def minimal_clean(c: Column, normalise: bool = False) -> Column:
    """The first stage's cleaning: matches are deleted, and lower case comes last."""
    x = text(nfc(c) if normalise else c)
    x = strip_instagram(strip_mentions(strip_tags(strip_giphy(strip_urls(x, "")), ""), ""))
    x = strip_phrases(strip_first_emoticons(strip_emoji(x, "")), rules.FIRST_UI_PHRASES, "")
    return F.lower(collapse(orphan_punct(x)))


def prompt_safe(c: Column, normalise: bool = False) -> Column:
    """A post as it may go into a prompt."""
    x = trim(text(nfc(c) if normalise else c))
    x = sub(sub(sub(x, r"https?://\S+", "[URL]"), r"\S+@\S+", "[EMAIL]"), r"\d{3}-?\d{3}-?\d{4}", "[PHONE]")
    return sub(F.translate(x, '"\n\r', "'  "), r"[!@#$%^&*()]+", " ")


def tokens(c: Column) -> Column:
    return F.filter(F.split(text(c), rx(f"{SPACE}+")), lambda w: w != "")


def count_tokens(c: Column) -> Column:
    return F.size(tokens(c))


def count_words(c: Column) -> Column:
    """Tokens with a letter or digit."""
    return F.size(F.filter(tokens(c), lambda w: w.rlike("[a-zA-ZÀ-ỹ0-9]")))


def removal_reason(c: Column) -> Column:
    """Why a cleaned comment is too short; null counts as invalid."""
    n = count_words(c)
    return F.when(c.isNull(), "Empty or invalid comment").when(n == 0, "Empty comment after cleaning").when(n == 1, "Single word comment").when(n == 2, "Two words comment").when(n == 3, "Three words comment").otherwise("Other reason")


def contains_any(c: Column, literals: Sequence[str]) -> Column:
    """Any literal inside the text, ignoring case; false for null."""
    return F.lit(False) if not literals else F.coalesce(c.rlike(rx("|".join(map(quoted, literals)), icase=True)), F.lit(False))


def special(c: Column, literals: Sequence[str]) -> Column:
    """Any literal inside the lower-cased text as it is written; false for null."""
    x = trim(lower(c))
    return F.lit(False) if not literals else c.isNotNull() & reduce(lambda a, b: a | b, (F.contains(x, F.lit(p)) for p in literals))


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(text(c)) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(text(c))


def fraction(c: Column, part: float) -> Column:
    return F.substring(text(c), F.lit(1), F.floor(F.length(text(c)) * F.lit(part)).cast("int"))


def token_estimate(c: Column) -> Column:
    """A quarter of the characters, at least 1; 0 for null or empty."""
    return F.when(F.length(text(c)) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(text(c)) / 4))).cast("long")


def numbered(items: Column, label: str = "") -> Column:
    """An array as numbered lines."""
    return F.array_join(F.transform(items, lambda x, i: F.concat(F.lit(label), (i + 1).cast("string"), F.lit(". "), text(x))), "\n")


def fill(template: str, **values: Column) -> Column:
    """A template whose {name} parts are replaced, other braces staying as they are."""
    return reduce(lambda x, kv: F.replace(x, F.lit("{" + kv[0] + "}"), text(kv[1])), values.items(), F.lit(template))


def video_clean(c: Column) -> Column:
    """A comment of the video source: emoji, emoticons on either side, runs of any character, odd marks."""
    x = sub(text(c), r"[\x{1F000}-\x{10FFFF}\x{2600}-\x{27FF}]")
    x = F.regexp_replace(x, F.lit(r"[:=xX][\-\^]?[)(\[\]DdPpOo3<>/\\|}{@*]+"), F.lit(""))
    x = F.regexp_replace(x, F.lit(r"[)(\[\]DdPpOo3<>/\\|}{@*]+[:=xX][\-\^]?"), F.lit(""))
    x = F.regexp_replace(x, F.lit(r"(.)\1{2,}"), F.lit("$1$1"))
    x = F.regexp_replace(x, F.lit(_VIDEO_ODD), F.lit(" "))
    return collapse(x)


def valid_video_comment(c: Column, acronyms: Sequence[str] = ("vnch", "vncs", "vn")) -> Column:
    """Not only emoji, not only emoticons, and more than three words or an allowed acronym."""
    def enough(x: Column) -> Column:
        words = F.filter(F.split(x, " "), lambda w: w.rlike(r"[a-zA-Z\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}]"))
        allowed = lambda own: F.exists(own, lambda w: F.lower(w).isin(*acronyms)) if acronyms else F.lit(False)
        return (F.length(x) > 0) & let(words, lambda own: (F.size(own) > 3) | allowed(own))

    odd = c.rlike(r"^[\x{1F000}-\x{10FFFF}\x{2600}-\x{27FF}\s]*$") | c.rlike(r"^[:=xX\-\^]*[)(\[\]DdPpOo3<>/\\|}{@*\s]*$")
    return F.coalesce(~odd & let(video_clean(c), enough), F.lit(False))


def has_url(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)" + VIDEO_URL), F.lit(False))


def thread_clean(c: Column) -> Column:
    """A comment of the threads source without leading time, date, author and pin marks, trailing counts
    and lines of numbers only.  Null stays null."""
    units, x = "giờ|phút|ngày|tuần|tháng|năm", c
    after = (rf"^\d+\s+({units})(?:\s*\n|\s*·|\s*$)", r"^(\d{1,2}/\d{1,2}/\d{2,4})(?:\s*\n|\s*·|\s*$)", r"(?:^|\n)\s*·\s*\n?\s*Tác giả\s*\n", r"(?:^|\n)\s*Tác giả\s*\n", r"^Đã ghim\s*\n")
    def skip(v: Column, p: str) -> Column:
        rest = trim(F.regexp_extract(v, rf"(?isu)(?:{p})(.*)$", 2 if p.startswith(("^\\d", "^(\\d")) else 1))
        return let(rest, lambda r: F.when(r != "", r).otherwise(v))

    for p in after:
        x = let(x, lambda v: skip(v, p))  # noqa: B023  used at once
    whole = trim(F.regexp_extract(c, rf"(?isu)(?:\d+\s+(?:{units})|\d{{1,2}}/\d{{1,2}}/\d{{2,4}})\s*\n?\s*(?:·\s*\n?\s*Tác giả\s*\n)?(.*)", 1))
    x = let(x, lambda v: F.when(v != c, v).otherwise(let(whole, lambda w: F.when(w != "", w).otherwise(v))))
    for p in (r"\s*[\d.,]+K\s*$", r"\s*\d+\s*[,.:]\s*\d+\s*K\s*$", r"\s+\d+\s*$", r"\s*\d+(?:\s*[,.\s]\s*\d+)*\s*$"):
        x = F.regexp_replace(x, F.lit("(?i)" + p), F.lit(""))
    lines = F.filter(F.split(x, "\n"), lambda y: let(trim(y), lambda t: (t != "") & ~t.rlike(r"^\d+$|^\d{1,2}/\d{1,2}/\d{4}$|^[\d,.]+K?$")))
    bare = F.regexp_replace(trim(c), F.lit(r"\s*[\d,.]+K\s*$"), F.lit(""))
    last = lambda v: F.when(v.rlike(r"^[.,:;]$"), "").otherwise(F.when((F.length(v) < 3) & (F.length(c) > 10), bare).otherwise(v))
    return F.when(c.isNotNull(), let(trim(F.array_join(lines, "\n")), last))


def remove_first(c: Column, name: Column) -> Column:
    """The text without the first place where a name stands."""
    at = F.position(name, c)
    return F.when((F.length(name) > 0) & (at > 0), F.concat(F.substring(c, F.lit(1), at - 1), F.substring(c, at + F.length(name), F.length(c)))).otherwise(c)


def comment_id(author: Column, body: Column, date: Column, tag: str = "") -> Column:
    """tc_ and the MD5 of author, first 100 characters, date and a tag."""
    return F.concat(F.lit("tc_"), F.md5(F.concat_ws("|", text(author), F.substring(text(body), 1, 100), text(date), F.lit(tag))))


def author_or(author: Column, key: Column) -> Column:
    """The author, or a name made from the row's key where there is none."""
    return F.coalesce(F.when(trim(author) != "", author), F.concat(F.lit("deleted_"), F.substring(F.md5(key.cast("string")), 1, 8)))


def masked(key: Column) -> Column:
    return F.concat(F.lit("..."), F.right(text(key), F.lit(4)))


def slug(model: Column) -> Column:
    return F.translate(model, "-.", "__")


def version_token(path: Column, default: str = "v2") -> Column:
    found = F.regexp_extract(text(path), r"(?:^|/)(v\d+)(?:/|$)", 1)
    return F.when(found != "", found).otherwise(F.lit(default))


def percent(c: Column, places: int = 1) -> Column:
    return F.concat(F.format_number(c, places), F.lit("%"))
