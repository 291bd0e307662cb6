"""Text functions as Column expressions, all within the JVM.

Case folding is lower(upper()) and the tables below; regular expressions get classes of their own for word characters and white space,
as Java's differ from version to version. Arguments that a lambda refers to should be columns, not long expressions: they are evaluated for each element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that upper() would lose, with what stands for them meanwhile (for the dotless i, which folds to itself, a noncharacter), and the way back.
BEFORE, BETWEEN = {"ẞ": "ß", "ı": "\ufdd0"}, {"\ufdd0": "ı"}
#: Characters that lower(upper()) leaves and that fold to another one (final sigma, Cherokee), by Python's tables.
AFTER = {c: c.casefold() for c in map(chr, range(128, 0x110000)) if len(c.casefold()) == 1 and c.casefold() != c and c.upper().lower() == c} | {"ς": "σ"}
#: Greek and Cherokee: all that becomes a character of AFTER in lower case is among these.
TURNED = r"[\u0370-\u03FF\u1380-\u13FF\uAB40-\uABBF]"
#: Characters stripped from both ends of entities and titles, and of headings.
EDGES, HEADING_EDGES = " \t\r\n-:;,.", " \t\r\n#-:;,."
#: What counts as white space, as characters and as a class of patterns. Plain classes are faster than (?U)\s.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Java looks single characters below 256 up in one table, and the intersection ends at its first part for most others: two tests a character instead of ten.
_NARROW, _WIDE = "".join(f"\\x{ord(c):02X}" for c in SPACES if c != " " and ord(c) < 256), r"[\u1680-\u3000&&[\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]"
S, S_BUT_SPACE = rf"[\x20{_NARROW}{_WIDE}]", f"[{_NARROW}{_WIDE}]"
#: Characters of words, and borders of words.
W = r"[\p{L}\p{N}_]"
BEGIN, END = f"(?<!{W})", f"(?!{W})"
#: The patterns of tokens and of names.
WORD = r"[a-z0-9]+(?:'[a-z0-9]+)?"
PROPER = BEGIN + r"(?:[A-Z][a-z]+|[A-Z]{2,})(?:[ \t]+(?:[A-Z][a-z]+|[A-Z]{2,}))*" + END
#: Words that head sections and aren't names.
SECTION_WORDS = ["Article", "Context", "Cross", "Discussion", "Document", "Entities", "Interaction", "Integrated", "Relation", "Relations", "Shared", "Synthesis"]


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bound(x: Column, of) -> Column:
    """of(x), with x evaluated once, however often of names it: it is a lambda's argument."""
    return F.transform(F.array(x), of)[0]


def _replaced(x: Column, table: dict[str, str]) -> Column:
    for a, b in table.items():
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def fold(x: str | Column) -> Column:
    """Full case folding of every character, also of those whose fold is several: the lower case of the upper case, but for the characters of the tables."""
    # x is a lambda's argument, so that it is evaluated once. ASCII needs its lower case only, and few texts hold what the table turns.
    return F.transform(F.array(col(x)), lambda y: F.when(F.octet_length(y) == F.length(y), F.lower(y)).otherwise(F.when(F.rlike(y, F.lit(TURNED)), _turned(_lowered(y))).otherwise(_lowered(y))))[0]


def _lowered(x: Column) -> Column:
    # With nothing between them, the optimizer would take lower(upper()) for lower().
    return F.lower(_replaced(F.upper(_replaced(x, BEFORE)), BETWEEN))


def _turned(x: Column) -> Column:
    return F.translate(x, "".join(AFTER), "".join(AFTER.values()))


def strip(x: str | Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(col(x), F.lit(SPACES))


def squash(x: str | Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    # A single space stays as it is, so it isn't matched.
    return F.trim(F.regexp_replace(col(x), f"{S_BUT_SPACE}{S}*| {S}+", " "))


def strip_of(x: str | Column, characters: str) -> Column:
    return F.btrim(col(x), F.lit(characters))


def tokens(x: str | Column) -> Column:
    return F.regexp_extract_all(fold(x), F.lit(WORD), F.lit(0))


def norm(x: str | Column) -> Column:
    """The tokens joined by a space."""
    return F.array_join(tokens(x), " ")


def entity_key(x: str | Column) -> Column:
    return fold(squash(x))


def entity_normal_key(x: str | Column) -> Column:
    """entity_key() without characters at the ends that aren't word characters."""
    return F.regexp_replace(entity_key(x), f"^{W.replace('[', '[^', 1)}+|{W.replace('[', '[^', 1)}+$", "")


def clean_entity(x: str | Column) -> Column:
    return strip_of(F.regexp_replace(col(x), f"{S}+", " "), EDGES)


def distinct_by(array: str | Column, key) -> Column:
    """Elements whose key is new, in order; for short arrays. The array, and the key of each element, are made once."""
    keyed = F.transform(col(array), lambda x: F.struct(key(x).alias("k"), x.alias("x")))
    new = lambda rows: lambda keys: F.filter(rows, lambda y, i: F.array_position(keys, y["k"]) == i + 1)
    return F.transform(bound(keyed, lambda rows: bound(F.transform(rows, lambda y: y["k"]), new(rows))), lambda y: y["x"])


def normalized_entities(array: str | Column, min_chars: int = 1, key=fold) -> Column:
    """Cleaned entities of at least min_chars characters, the first of those with equal keys; nulls go."""
    clean = F.transform(F.filter(col(array), lambda x: x.isNotNull()), clean_entity)
    return distinct_by(F.filter(clean, lambda x: F.length(x) >= max(1, min_chars)), key)


def ngrams(array: str | Column, n: int = 5) -> Column:
    """Distinct runs of n tokens, each joined by a space; empty if there are fewer."""
    array = col(array)
    runs = F.transform(F.sequence(F.lit(1), F.size(array) - n + 1), lambda i: F.array_join(F.slice(array, i, n), " "))
    return F.when(F.size(array) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def first_sentence(x: str | Column) -> Column:
    """Up to the first end of a sentence that white space follows, without the end; the whole if nothing remains."""
    first = F.split(col(x), f"(?<=[.!?]){S}+", 2)[0]
    return F.coalesce(F.nullif(F.rtrim(first, F.lit(" .!?")), F.lit("")), col(x))


def section_sentence(x: str | Column, otherwise: str | Column) -> Column:
    """The first sentence of a paragraph as its title."""
    first = F.split(squash(x), f"(?<=[.!?]){S}+", 2)[0]
    return bound(strip_of(first, " .!?"), lambda y: F.when(y != "", y).otherwise(col(otherwise)))


def clean_title(x: str | Column) -> Column:
    out = F.regexp_replace(strip(x), "^#{1,6}" + S + "+", "")
    out = F.regexp_replace(out, "^[-*+]" + S + "+", "")
    return strip_of(F.regexp_replace(out, f"{S}+", " "), EDGES)


def clean_heading(x: str | Column) -> Column:
    return strip_of(F.regexp_replace(col(x), f"{S}+", " "), HEADING_EDGES)


def _clipped(x: Column, most: int, least: int) -> Column:
    """At most most - 1 characters, up to the last space unless that leaves under least."""
    head = F.substring(x, 1, most - 1)
    cut = strip(F.regexp_replace(head, r"(?s) [^ ]*$", ""))
    return F.when(F.length(cut) < least, strip(head)).otherwise(cut)


def truncate_title(x: str | Column, most: int = 80) -> Column:
    x = col(x)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.rtrim(_clipped(x, most, 20), F.lit(".,;:")), F.lit("...")))


def truncate_text(x: str | Column, most: int) -> Column:
    """x itself up to most characters (or if most is 0 or less), else cut at a space, with dots."""
    x = col(x)
    if most <= 0:
        return x
    return F.when(F.length(x) <= most, x).otherwise(F.concat(_clipped(x, most, most // 2), F.lit("...")))


def infer_title(text: str | Column, index: str | Column) -> Column:
    """The first line that has anything to say: a heading whole, another line's first sentence; else the text's first sentence, else a number."""
    lines = F.filter(F.split(col(text), r"\r\n|[\n\r\u000B\f\u001C\u001D\u001E\u0085\u2028\u2029]"), lambda x: clean_title(x) != "")
    line = F.try_element_at(lines, F.lit(1))
    heading = F.startswith(strip(line), F.lit("#"))
    title = F.when(heading, clean_title(line)).otherwise(first_sentence(clean_title(line)))
    return F.coalesce(truncate_title(F.nullif(title, F.lit(""))), F.concat(F.lit("Untitled source "), col(index).cast("string")))


def proper_nouns(x: str | Column) -> Column:
    """Runs of capitalised words: those of several words that aren't only spelled with tabs, and LLM and CPT."""
    found = F.regexp_extract_all(col(x), F.lit(PROPER), F.lit(0))
    return F.filter(found, lambda p: ~p.isin(SECTION_WORDS) & (F.contains(p, F.lit(" ")) | p.isin("LLM", "CPT")))


def mentions(entity: str | Column, text: str | Column) -> Column:
    """How often entity stands in text between characters that aren't word characters, whatever its case; 0 for an empty one."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(col(entity), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    pattern = F.concat(F.lit("(?iu)" + BEGIN), quoted, F.lit(END))
    return F.when(strip(entity) == "", F.lit(0)).otherwise(F.size(F.regexp_extract_all(col(text), pattern, F.lit(0))))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def stable_id(*parts: str | Column) -> Column:
    """SHA-1 of the parts joined by the unit separator; a null part counts as empty."""
    return F.sha1(F.array_join(F.array(*[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]), "\u001f").cast("binary"))


def round4(x: Column) -> Column:
    """Rounded to four places as Python rounds: by the exact binary value, halves to even.

    x times 10,000 is split into its double and the rest that the double lacks (x in two parts of 26 bits each times 10,000 is
    exact), and the rest decides where the double lies half way.
    """
    # x is a lambda's argument, so that it is evaluated once, however often it is named.
    return F.transform(F.array(x), _rounded)[0]


def _rounded(x: Column) -> Column:
    p = x * 10000.0
    c = x * 134217729.0
    high = c - (c - x)
    rest = (high * 10000.0 - p) + (x - high) * 10000.0
    low = F.floor(p).cast("double")
    half = p - low
    up = (half > 0.5) | ((half == 0.5) & ((rest > 0) | ((rest == 0) & (F.pmod(low, F.lit(2.0)) == 1.0))))
    down = (half == 0.0) & (rest < 0)
    return F.when(down, low).when(up, low + 1.0).otherwise(low) / 10000.0
