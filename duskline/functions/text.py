"""Rules over notice and recommendation text, as native Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels and the texts that give them, tried from top to bottom.
FAMILY_MARKERS = (
    ("containers", ("aks", "kubernetes", "container")),
    ("compute", ("function", "app service", "web app", "vm", "virtual machine")),
    ("data", ("sql", "mysql", "postgres", "cosmos", "database")),
    ("storage", ("storage", "blob", "files")),
    ("security", ("key vault", "identity", "entra", "aad")),
    ("network", ("network", "gateway", "load balancer", "dns")),
)
FAMILY_DEFAULT = "platform"
STATUS_MARKERS = (
    ("retired", "retired"),
    ("retire", "retiring"),
    ("deprecated", "deprecated"),
    ("preview", "preview"),
)
NOTICE_CLASSES = (
    (("key vault",), "azure.key_vault"),
    (("python", "function"), "azure.functions.python"),
)
RETIREMENT_TAG = "Retirements"
RETIREMENT_STEMS = ("retir", "deprecat")
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for null, empty and all-space text; never null."""
    return F.coalesce(F.trim(_col(c)) == "", F.lit(True))


def none_if_blank(c: Column | str) -> Column:
    return F.when(~is_blank(c), _col(c))


def first_label(rules: list[tuple[Column, str]], default: Column | str) -> Column:
    """Label of the first rule that holds, else the default."""
    default = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(*[F.when(test, F.lit(label)) for test, label in rules], default)


def contains_any(text: Column, needles: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def status_label(status: Column | str) -> Column:
    """Notice status folded to retired / retiring / deprecated / preview / unknown / as given."""
    folded = F.lower(F.trim(_col(status)))
    rules = [(is_blank(status), "unknown")]
    rules += [(folded.contains(marker), label) for marker, label in STATUS_MARKERS]
    return first_label(rules, folded)


def technology_family(service: Column | str, runtime: Column | str, title: Column | str) -> Column:
    """Technology family of a notice: first marker found anywhere in its text.

    The markers are plain texts, so this is a byte search rather than a regex.
    """
    text = F.lower(F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in (service, runtime, title)]))
    return first_label([(contains_any(text, markers), label) for label, markers in FAMILY_MARKERS], FAMILY_DEFAULT)


def impact_scope(
    service: Column | str, feature: Column | str, runtime: Column | str, version: Column | str
) -> Column:
    """What a notice reaches, from the most specific column that is filled."""
    order = ((runtime, "runtime"), (feature, "feature"), (version, "runtime"), (service, "service"))
    return first_label([(~is_blank(c), label) for c, label in order], "configuration")


def notice_class(title: Column | str, summary: Column | str) -> Column:
    """Service class of a notice by words in title and summary."""
    text = F.lower(F.concat_ws(" ", _col(title), _col(summary)))
    rules = []
    for words, label in NOTICE_CLASSES:
        test = text.contains(words[0])
        for word in words[1:]:
            test = test & text.contains(word)
        rules.append((test, label))
    return first_label(rules, "unclassified")


def text_matches(pattern: str | None, *parts: Column | str) -> Column:
    """Case-insensitive regex search over the parts joined by one space; no pattern keeps all."""
    if not pattern:
        return F.lit(True)
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in parts]).rlike(f"(?i){pattern}")


def mentions_retirement(*parts: Column | str, whole_term: bool = False) -> Column:
    """Whether any part has a word that starts with (or, ``whole_term``, equals) a retirement stem."""
    end = r"\b" if whole_term else ""
    pattern = rf"(?i)\b({'|'.join(RETIREMENT_STEMS)}){end}"
    test = F.lit(False)
    for part in parts:
        test = test | F.coalesce(_col(part).rlike(pattern), F.lit(False))
    return test


def is_tagged(tags: Column | str, tag: str = RETIREMENT_TAG) -> Column:
    """Whether the tag array holds exactly ``tag``; a null array counts as empty."""
    return F.coalesce(F.array_contains(_col(tags), tag), F.lit(False))


# The two ways a date is written in a notice.
_NAMES = "|".join(MONTHS)
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_DAY_FIRST = rf"{_DAY}\s+({_NAMES})\s+(\d{{4}})"
_MONTH_FIRST = rf"({_NAMES})\s+{_DAY},?\s+(\d{{4}})"
# End of the fixed values.


def _whole(pattern: str) -> str:
    """The pattern between word ends, with case and character classes read as Unicode."""
    return rf"(?iU)\b(?:{pattern})\b"


def _let(value: Column, build) -> Column:
    """``build`` over a value that is evaluated once, however often ``build`` uses it.

    Without this the searches below would be repeated at each use, and the
    generated code would grow with every repetition.
    """
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _read_date(piece: Column) -> Column:
    """The date a matched piece spells in either order; null when there is no such day.

    The day is added to the first of its month and must stay in that month, so
    an impossible date costs no exception.
    """
    names = F.array(*[F.lit(m) for m in MONTHS])
    month = F.nullif(F.array_position(names, F.lower(F.regexp_extract(piece, rf"(?iU){_NAMES}", 0))), F.lit(0)).cast("int")
    year = F.nullif(F.right(piece, F.lit(4)).try_cast("int"), F.lit(0))
    day = F.regexp_extract(piece, r"(?U)\d{1,2}", 0).try_cast("int")

    def inside_month(first: Column) -> Column:
        return _let(F.date_add(first, day - 1), lambda reached: F.when(F.trunc(reached, "month") == first, reached))

    return _let(F.make_date(year, month, F.lit(1)), inside_month)


def _date_branch(text: Column, pattern: str) -> Column:
    """(position, date) of the first match of one order, or null."""
    position = F.regexp_instr(text, F.lit(_whole(pattern)))
    return _let(
        _let(F.regexp_extract(text, _whole(pattern), 0), _read_date),
        lambda found: F.when(found.isNotNull(), F.struct(position.alias("position"), found.alias("date"))),
    )


def retire_date(text: Column | str) -> Column:
    """First English date in a text, written day-month-year or month-day-year.

    Each order contributes only its first match; an impossible date (30
    February) drops that order, and the earlier position wins. Nearly always the
    earliest match of either order is a real date and one search settles it;
    only otherwise are the two orders searched one by one. A text without a
    month name is not searched at all.
    """
    text = _col(text)
    search = F.regexp_extract(text, _whole(f"{_DAY_FIRST}|{_MONTH_FIRST}"), 0)
    earliest = _let(F.lower(text), lambda folded: F.when(contains_any(folded, MONTHS), search))
    one_by_one = F.least(_date_branch(text, _DAY_FIRST), _date_branch(text, _MONTH_FIRST))["date"]
    return _let(earliest, lambda piece: F.coalesce(_read_date(piece), F.when(piece != "", one_by_one)))
