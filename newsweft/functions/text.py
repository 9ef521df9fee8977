"""Text and name cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Accented letters and the plain letters that replace them.
ACCENTED = "àáâãäåāèéêëēìíîïıīòóôõöōùúûüūýÿȳçñşÀÁÂÃÄÅĀÈÉÊËĒÌÍÎÏİĪÒÓÔÕÖŌÙÚÛÜŪÝŸȲÇÑŞ"
PLAIN = "aaaaaaaeeeeeiiiiiioooooouuuuuyyycnsAAAAAAAEEEEEIIIIIIOOOOOOUUUUUYYYCNS"
#: Honorifics and titles that are taken out of names as whole words.
HONORIFICS = "Mr Ms Mrs Miss Dr Sir Dame Hon Professor Prof Rev".split()
TITLE_WORDS = "QC CBE MBE BM MD DM BHB CBC Reverend Recorder Headteacher Councillor Cllr Father Fr Mother Grandmother Grandfather Creator".split()
MARKUP_WORDS = "et al,www,href,http,https,Ref,rel,eu,span,Rd,St".split(",")
#: French titles by the gender they tell.
FRENCH_TITLES = {
    "female": "mme mmes madame mesdames mlle mlles mademoiselle mesdemoiselles vve veuve présidente".split(),
    "male": "m. mm. monsieur messieurs mgr monseigneur président".split(),
}
DOUBLE_QUOTES = "”“〝〞"
_NOT_WORD = r"[^\p{L}\p{N}_]"


def accent_fold(text: Column) -> Column:
    """Accented letters become plain ones (both cases)."""
    return F.translate(text, ACCENTED, PLAIN)


def clean_text_en(text: Column) -> Column:
    """Normalises spaces, accents, line ends and double quotes of English news text; the order matters."""
    out = accent_fold(F.replace(text, F.lit("\u00a0"), F.lit(" ")))
    for old, new in (("\n", ".\n "), ("..\n ", ".\n "), (". .\n ", ".\n "), ("  ", " "), ("\\n", " ")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.translate(out, DOUBLE_QUOTES, '"' * len(DOUBLE_QUOTES))


def clean_text_fr(text: Column) -> Column:
    """The same for French text: accents and line ends stay, apostrophes between letters are straightened."""
    out = F.replace(text, F.lit("\u00a0"), F.lit(" "))
    for old, new in (("..\n ", ".\n "), (". .\n ", ".\n "), ("  ", " "), ("\\n", " ")):
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, r"(\.)([ \n\r]+)(\.)", r".$2 ")
    out = F.translate(out, DOUBLE_QUOTES, '"' * len(DOUBLE_QUOTES))
    out = F.regexp_replace(out, r"(?<=[\p{L}\p{N}_])’(?=[\p{L}\p{N}_])", "'")
    return F.replace(out, F.lit("*"), F.lit(" "))


def clean_name(name: Column) -> Column:
    """Special characters to spaces, no trailing possessive, single spaces."""
    out = F.trim(F.regexp_replace(name, _NOT_WORD, " "))
    out = F.regexp_replace(out, r" s$", "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def remove_titles(name: Column) -> Column:
    words = "|".join(HONORIFICS + TITLE_WORDS + MARKUP_WORDS)
    return F.trim(F.regexp_replace(name, rf"\b({words})\b", ""))


def trim_marks(name: Column) -> Column:
    """Non-word characters off both ends."""
    return F.regexp_replace(name, rf"^{_NOT_WORD}+|{_NOT_WORD}+$", "")


def name_tokens(name: Column) -> Column:
    return F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")


def name_length_is_invalid(name: Column) -> Column:
    """At most one or more than six tokens."""
    return (F.size(name_tokens(name)) <= 1) | (F.size(name_tokens(name)) > 6)


def contains_digit(text: Column) -> Column:
    return text.rlike(r"\d")


def first_name(name: Column) -> Column:
    """The first token; null if there is no space."""
    return F.when(F.trim(name).contains(" "), F.element_at(name_tokens(name), 1))


def almost_same(a: Column, b: Column, distance: int = 1) -> Column:
    """Edit distance of at most ``distance``; empty or null is never almost the same."""
    return F.coalesce((a != "") & (b != "") & (F.levenshtein(a, b, distance) >= 0), F.lit(False))


def blocked_token(name: Column, blocklist: list[str]) -> Column:
    """Whether a whole token of the name is on the list (case as in the list or not)."""
    return F.arrays_overlap(F.split(F.lower(name), r"\s+"), F.array(*[F.lit(w.lower()) for w in blocklist]))


def blocked_substring(name: Column, blocklist: list[str]) -> Column:
    """Whether any entry of the list stands anywhere in the name."""
    out = F.lit(False)
    for w in blocklist:
        out = out | F.contains(F.lower(name), F.lit(w.lower()))
    return out


def crawl_text(text: Column) -> Column:
    """Control characters to spaces, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, r"[\x00-\x1f\x7f]", " ")))


def topic_tokens(text: Column) -> Column:
    """Lower-case tokens of 3 to 50 letters, digits or hyphens."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9\-]{3,50}"), F.lit(0))


def french_title_gender(name: Column) -> Column:
    """female before male; null without a title that tells."""
    low = F.concat(F.lit(" "), F.lower(name), F.lit(" "))
    has = lambda words: F.greatest(*[F.contains(low, F.lit(f" {w} ")) for w in words])
    return F.when(has(FRENCH_TITLES["female"]), "female").when(has(FRENCH_TITLES["male"]), "male")
