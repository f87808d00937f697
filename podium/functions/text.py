"""Name and text column functions.

Each function returns native column expressions; none calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.rules import CAPS_SURNAME_PATTERN, PLACEHOLDER_NAME, PLACEHOLDER_SPLIT

# Token classes of a personal name (case-insensitive, optional dot); parameter lists of this
# library, not rules of the series.
NAME_TITLES = ("mr", "mrs", "ms", "miss", "dr", "prof", "rev", "sir")
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "phd", "md", "esq")
NAME_PARTICLES = ("af", "al", "av", "bin", "da", "das", "de", "del", "della", "den", "der", "di", "do", "dos", "du", "el",
                  "ibn", "la", "le", "san", "santa", "st", "ste", "ten", "ter", "van", "von", "zu")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_first_rest(c) -> tuple[Column, Column]:
    """First token is the first name, all remaining tokens the last name."""
    s = F.trim(_c(c))
    return F.substring_index(s, " ", 1), F.regexp_replace(s, r"^[^ ]* ?", "")


def split_first_last(c) -> tuple[Column, Column]:
    """First token and last token; middle tokens are dropped."""
    parts = F.split(_c(c), " ")
    return F.element_at(parts, 1), F.element_at(parts, -1)


def split_comma_aware(c) -> tuple[Column, Column]:
    """'Last, First x' -> (First, Last); 'A B C' -> (A, 'B C'); 'A' -> (A, ''); '' -> ('', '')."""
    s = F.trim(F.coalesce(_c(c), F.lit("")))
    head = F.trim(F.substring_index(s, ",", 1))
    tail = F.trim(F.regexp_replace(s, r"^[^,]*,", ""))
    tail_first = F.regexp_extract(tail, r"^([^ \t]+)", 1)
    tokens = F.split(F.regexp_replace(s, r"[ \t]+", " "), " ")
    has_comma = F.instr(s, ",") > 0
    first = (F.when(s == "", F.lit(""))
             .when(has_comma, tail_first)
             .otherwise(F.element_at(tokens, 1)))
    last = (F.when(s == "", F.lit(""))
            .when(has_comma, head)
            .when(F.size(tokens) == 1, F.lit(""))
            .otherwise(F.array_join(F.slice(tokens, F.lit(2), F.size(tokens)), " ")))
    return first, last


def capitalize_parts(c, separators: str = "-'") -> Column:
    """Capitalise each word; capitalisation restarts after each separator character.

    Implementation: pad every separator with spaces, collapse blank runs, ``initcap``,
    then remove the padding again.
    """
    s = F.trim(_c(c))
    for sep in separators:
        s = F.replace(s, F.lit(sep), F.lit(f" {sep} "))
    s = F.initcap(F.trim(F.regexp_replace(s, r"\s+", " ")))
    for sep in separators:
        s = F.replace(s, F.lit(f" {sep} "), F.lit(sep))
    return s


def split_caps_surname(c, pattern: str = CAPS_SURNAME_PATTERN,
                       groups: tuple[int, int] = (1, 4)) -> tuple[Column, Column, Column]:
    """Mixed-case given names then an upper-case surname ('NEED NAME' -> Need, Name).

    ``pattern`` is the wording of the source and ``groups`` its groups for the given names
    and the surname (see ``CAPS_SURNAME_VARIANTS``). Returns (first, last, matched). Rows that do not match give null names and
    ``matched = false`` so the caller can quarantine them.
    """
    s = _c(c)
    placeholder = F.trim(s) == F.lit(PLACEHOLDER_NAME)
    matched = s.rlike(pattern)
    first = (F.when(placeholder, F.lit(PLACEHOLDER_SPLIT[0]))
             .when(matched, F.trim(F.regexp_extract(s, pattern, groups[0]))))
    last = (F.when(placeholder, F.lit(PLACEHOLDER_SPLIT[1]))
            .when(matched, capitalize_parts(F.regexp_extract(s, pattern, groups[1]))))
    return first, last, placeholder | matched


def _token_class(token) -> Column:
    bare = F.lower(F.rtrim(token, F.lit(".")))
    return (F.when(bare.isin(*NAME_TITLES), "title").when(bare.isin(*NAME_SUFFIXES), "suffix")
            .when(bare.isin(*NAME_PARTICLES), "particle").otherwise("name"))


def _tokens(text) -> Column:
    """(text, class) of the blank-separated tokens of ``text``."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.struct(w.alias("text"), _token_class(w).alias("kind")))


def _joined(tokens) -> Column:
    return F.array_join(F.transform(tokens, lambda t: t["text"]), " ")


def split_human(c) -> tuple[Column, Column]:
    """First and last name of a full name, by a fold over its classified tokens.

    Nicknames in brackets or double quotes, titles before the first name and suffixes are left out. ``Last, First
    Middle`` is read by its comma; a part behind a comma that holds suffixes alone is no name.
    A particle behind the first name begins the last name (``Juan de la Vega``), else the last
    token is it and those between are dropped. One word is a first name, behind a title a last
    name; the missing one is empty. Null stays null.
    """
    text = F.regexp_replace(_c(c), r"\([^()]*\)|\"[^\"]*\"|\u201c[^\u201d]*\u201d", " ")
    parts = F.transform(F.split(text, ","), _tokens)
    own = lambda p: F.exists(p, lambda t: ~t["kind"].isin("suffix", "title"))
    start = F.struct(F.lit("").alias("first"), F.lit("").alias("last"), F.lit(False).alias("title"),
                     F.lit(False).alias("open"))

    def step(state, token):
        kind, word, none_yet = token["kind"], token["text"], state["first"] == ""
        first = F.when(none_yet & ~kind.isin("title", "suffix"), word).otherwise(state["first"])
        last = (F.when(none_yet | (kind == "suffix"), state["last"])
                .when(state["open"], F.concat(state["last"], F.lit(" "), word)).otherwise(word))
        return F.struct(first.alias("first"), last.alias("last"),
                        (state["title"] | (none_yet & (kind == "title"))).alias("title"),
                        (state["open"] | (~none_yet & (kind == "particle"))).alias("open"))

    def done(state):
        alone = (state["last"] == "") & state["title"]
        return F.struct(F.when(alone, "").otherwise(state["first"]).alias("first"),
                        F.when(alone, state["first"]).otherwise(state["last"]).alias("last"))

    plain = F.aggregate(F.get(parts, 0), start, step, done)
    behind = F.filter(F.slice(parts, F.lit(2), F.size(parts)), own)
    named = F.filter(F.get(behind, 0), lambda t: ~t["kind"].isin("title", "suffix"))
    before = F.filter(F.get(parts, 0), lambda t: ~t["kind"].isin("title", "suffix"))
    inverted = F.struct(F.get(named, 0)["text"].alias("first"), _joined(before).alias("last"))
    name = F.when(text.isNotNull(), F.when((F.size(behind) > 0) & own(F.get(parts, 0)), inverted).otherwise(plain))
    return name["first"], name["last"]


def full_name(first, last, sep: str = " ") -> Column:
    """Join with a separator; null when any part is null (unlike ``concat_ws``)."""
    return F.concat(_c(first), F.lit(sep), _c(last))


def rstrip_chars(c, chars: str) -> Column:
    """Trim blanks, then strip any trailing characters of ``chars`` (and blanks again)."""
    return F.trim(F.rtrim(F.trim(_c(c)), F.lit(chars)))


def distinct_names(names) -> Column:
    """An array of names as keys: blank or null ones become ``column <n>``, a name that came before
    gets its number appended; should some still be equal, all are led by their number."""
    filled = F.transform(_c(names), lambda x, i: F.when(F.trim(x) != "", x).otherwise(
        F.concat(F.lit("column "), (i + 1).cast("string"))))

    def numbered(all_):
        return F.transform(all_, lambda x, i: F.when(F.array_position(all_, x) == i + 1, x)
                           .otherwise(F.concat(x, F.lit(" "), (i + 1).cast("string"))))

    def led(all_):
        return F.when(F.size(F.array_distinct(all_)) == F.size(all_), all_).otherwise(
            F.transform(all_, lambda x, i: F.concat((i + 1).cast("string"), F.lit(": "), x)))

    return bind(bind(filled, numbered), led)


def bind(value, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]
