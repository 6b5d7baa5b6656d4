"""Text rules as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Text that a CSV read turns into null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Answers that mean "no match", compared in lower case.
NO_MATCH_TOKENS = ("none", "null", "n/a", "na", "")
# Labelled options that mean "nothing to match", compared in lower case.
EMPTY_OPTION_TOKENS = ("n/a", "na", "none", "")
NEGATIVE_CONTROL_PREFIX = "negative control"
# Legal forms ignored at the end of a normalised name.
LEGAL_SUFFIXES = ("ltd", "limited", "plc", "llp", "limited liability partnership", "alb")
# Words that give no letter to an acronym.
ACRONYM_STOP_WORDS = ("of", "for", "and", "the")
LETTER_TEMPLATE = (
    "Dear {name},\n\nWe are writing to you regarding your agreement with {buyer}. "
    "Please can you check your records for any unreported spend.\n\nBest regards,\n{sender}"
)
CANDIDATE_SEPARATOR = " | "
# ----------------------------------------------------------------------------

_WS = r"[\s\x1c-\x1f]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c) -> Column:
    """Strip every kind of white space from both ends (``trim`` strips blanks only)."""
    return F.regexp_replace(_col(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def na_to_null(c, tokens=NA_TOKENS) -> Column:
    c = _col(c)
    return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)


def strip_quotes(c) -> Column:
    """Remove one pair of wrapping quotes, then trim; a lone quote becomes ''."""
    p = trim_all(c)
    wrapped = (p.startswith('"') & p.endswith('"')) | (p.startswith("'") & p.endswith("'"))
    inner = F.substring(p, F.lit(2), F.greatest(F.length(p) - 2, F.lit(0)))
    return F.when(wrapped, trim_all(inner)).otherwise(p)


def no_match_to_null(c, tokens=NO_MATCH_TOKENS) -> Column:
    c = _col(c)
    return F.when(F.lower(c).isin(*tokens), F.lit(None)).otherwise(c)


def clean_prediction(c) -> Column:
    """Matcher output -> exact candidate text, or null for "no match"."""
    return no_match_to_null(strip_quotes(c))


def is_real_option(c) -> Column:
    return ~F.lower(trim_all(c)).isin(*EMPTY_OPTION_TOKENS)


def is_negative_control(error_type, truth) -> Column:
    err = F.lower(trim_all(F.coalesce(_col(error_type), F.lit(""))))
    gt = F.lower(trim_all(F.coalesce(_col(truth), F.lit(""))))
    return err.startswith(NEGATIVE_CONTROL_PREFIX) | gt.isin(*EMPTY_OPTION_TOKENS)


def metric_slug(c) -> Column:
    return F.translate(F.lower(_col(c)), " -", "__")


def buyer_group_key(c) -> Column:
    """Text before the first bracket, trimmed, ``&`` spelled ``and``."""
    return F.replace(trim_all(F.substring_index(_col(c), "(", 1)), F.lit("&"), F.lit("and"))


def pounds(c) -> Column:
    """en-GB currency text: £1,234.50, negatives as -£1,234.50."""
    c = _col(c)
    digits = F.format_number(F.abs(c).cast("decimal(38,2)"), 2)
    negative = (c < 0) & (digits != "0.00")
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), F.lit("£"), digits)


def draft_letter(name, buyer, sender: str) -> Column:
    out = F.lit(LETTER_TEMPLATE.replace("{sender}", sender))
    out = F.replace(out, F.lit("{buyer}"), _col(buyer))
    return F.replace(out, F.lit("{name}"), _col(name))


def render_prompt(template, name, candidates) -> Column:
    """Fill ``{input_name}`` and ``{candidates}`` (an array) in a template."""
    out = F.replace(_col(template), F.lit("{input_name}"), _col(name))
    return F.replace(out, F.lit("{candidates}"), F.array_join(_col(candidates), CANDIDATE_SEPARATOR))


def offer_without_input(candidates, name) -> Column:
    """Drop the asked name from its offer; other duplicates stay."""
    name = _col(name)
    return F.filter(_col(candidates), lambda x: x != name)


def valid_answer(answer, candidates) -> Column:
    """Keep an answer only when it is in the offered list."""
    answer = _col(answer)
    return F.when(F.array_contains(_col(candidates), answer), answer)


# ---- name normalisation rules ----------------------------------------------

def squash(c) -> Column:
    """Single blanks, no outer blanks."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def _spell_out(c) -> Column:
    """``&`` -> and; apostrophes and dots vanish; other punctuation is a blank."""
    c = F.regexp_replace(_col(c), "&", " and ")
    c = F.regexp_replace(c, "['’.]", "")
    return squash(F.regexp_replace(c, r"(?U)[^\w\s]|_", " "))


def name_key(c) -> Column:
    """Case, punctuation and spacing ignored."""
    return F.lower(_spell_out(c))


def drop_brackets(c) -> Column:
    return F.regexp_replace(_col(c), r"\([^)]*\)", " ")


def bracket_key(c) -> Column:
    return name_key(drop_brackets(c))


def suffix_key(c) -> Column:
    """Bracketed terms and any legal forms at the end ignored."""
    forms = "|".join(sorted(LEGAL_SUFFIXES, key=len, reverse=True))
    return F.regexp_replace(bracket_key(c), rf"( ({forms}))+$", "")


def acronym_keys(c) -> Column:
    """Distinct upper-case acronyms of a name of two or more words.

    With and without the stop words, and with words already in capitals either
    kept whole or cut to one letter.
    """
    words = F.split(_spell_out(drop_brackets(c)), " ")
    kept = F.filter(words, lambda w: ~F.lower(w).isin(*ACRONYM_STOP_WORDS))

    def initials(ws):
        return F.upper(F.array_join(F.transform(ws, lambda w: F.substring(w, 1, 1)), ""))

    def capitals_whole(ws):
        return F.upper(F.array_join(F.transform(
            ws, lambda w: F.when(w.rlike("^[A-Z]{2,3}$"), w).otherwise(F.substring(w, 1, 1))), ""))

    keys = F.array_distinct(F.array(
        initials(kept), initials(words), capitals_whole(kept), capitals_whole(words)))
    return F.when(F.size(words) >= 2, F.filter(keys, lambda k: F.length(k) >= 2)) \
        .otherwise(F.array().cast("array<string>"))


def acronym_input(c) -> Column:
    """A one-word input read as an acronym; null for longer names."""
    k = _spell_out(drop_brackets(c))
    return F.when(~k.contains(" ") & (F.length(k) >= 2), F.upper(k))


def name_tokens(c) -> Column:
    return F.array_distinct(F.filter(F.split(suffix_key(c), " "), lambda w: w != ""))
