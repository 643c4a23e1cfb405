"""Text normalisation as Column expressions. Only ``nfkc`` needs Python; it runs on Arrow batches."""

from __future__ import annotations

import unicodedata
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters printed for a dash, and for a slash in compositions.
DASHES = "‐‑‒–—―−﹣"
SLASHES = "∕⁄／"
ELLIPSIS = "…"
BLANK = r"[\s\x{00A0}\x{2007}\x{202F}]+"


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility normalisation, for which SQL has no function."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def fold_dashes(c: Column) -> Column:
    return F.translate(c, DASHES, "-" * len(DASHES))


def squeeze(c: Column) -> Column:
    """White space collapsed and trimmed; nothing left becomes null."""
    return F.nullif(F.trim(F.regexp_replace(c, BLANK, " ")), F.lit(""))


def clean(c: Column, compatibility: bool = False) -> Column:
    """Ellipses are gaps; optional NFKC."""
    gapped = F.translate(c, ELLIPSIS, " ")
    return squeeze(nfkc(gapped) if compatibility else gapped)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def text(c: Column) -> Column:
    """Cleaned text with plain dashes; never null."""
    return F.coalesce(clean(fold_dashes(c)), F.lit(""))


def search_key(*parts: Column) -> Column:
    return F.upper(F.concat_ws(" ", *[blank_to_null(text(p)) for p in parts]))


def composition_key(c: Column) -> Column:
    """Compositions compare without spaces, with one dash and one slash, in capitals."""
    folded = F.translate(fold_dashes(c), SLASHES, "/" * len(SLASHES))
    return F.upper(F.regexp_replace(F.coalesce(folded, F.lit("")), BLANK, ""))


def _code_point(number: Column) -> Column:
    """The character of a numeric entity; the replacement mark for numbers that are none."""
    n = number.cast("int")
    sound = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    return F.when(sound, F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")).otherwise("\ufffd")


#: Marks by name, as HTML defines them; and numbers that are read as Windows prints them.
NAMED_ENTITIES = {name[:-1]: mark for name, mark in html5.items() if name.endswith(";")}
WINDOWS = {f"#{n}": bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def unescape(c: Column) -> Column:
    """HTML entities, by name or number, as the marks they stand for; each once, so ``&amp;lt;`` is ``&lt;``. What is no
    entity stays."""
    pattern = r"&(#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
    table = F.create_map(*[F.lit(x) for pair in (NAMED_ENTITIES | WINDOWS).items() for x in pair])

    def mark(e: Column) -> Column:
        number = F.when(F.lower(e).startswith("#x"), F.conv(F.substr(e, F.lit(3)), 16, 10)).when(e.startswith("#"), F.substr(e, F.lit(2)))
        listed = F.try_element_at(table, F.when(number.isNotNull(), F.concat(F.lit("#"), number.cast("int").cast("string"))).otherwise(e))
        return F.coalesce(listed, F.when(number.isNotNull(), _code_point(number)), F.concat(F.lit("&"), e, F.lit(";")))

    between = F.split(c, pattern)
    marks = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), mark)
    joined = F.array_join(F.zip_with(between, marks, lambda x, m: F.concat(x, F.coalesce(m, F.lit("")))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def strip_tags(html: Column) -> Column:
    """Text of a piece of HTML: raised and lowered marks stick to the word before, other tags separate."""
    glued = F.regexp_replace(F.regexp_replace(html, r"(?i)\s*<su[pb]\b[^>]*>\s*", ""), r"(?i)</su[pb]\s*>", "")
    return squeeze(unescape(F.regexp_replace(glued, r"<[^>]*>", " ")))


def legal_xml(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", "�")


def loose_key(c: Column) -> Column:
    """Letters a-z and digits alone, for matching and never for display."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def unspaced(c: Column) -> Column:
    return F.regexp_replace(c, BLANK, "")


def spec_number(c: Column) -> Column:
    """Digits of a specification: ``SA-217`` and ``A217`` are 217."""
    return F.coalesce(F.regexp_extract(F.upper(fold_dashes(c)), r"^S?[A-Z]-?(\d+)", 1), F.lit(""))


def undouble(c: Column) -> Column:
    """A phrase printed twice in a row is printed once."""
    return F.regexp_replace(c, r"^(.+) \1$", "$1")


def note_reference(c: Column) -> Column:
    """The first ``[Note (n)]`` as ``(n)``, else empty."""
    return F.coalesce(F.regexp_extract(c, r"\[Notes? (\(\d+\))", 1), F.lit(""))


# The grammar of printed values, from its parts: digits with separators, a sign or a dash, a unit in brackets, letters of
# notes or of a unit. A word of a row is one such value, or what stands between white space.
DIGITS = r"[0-9]+(?:[.,][0-9]+)*[.,]?"
THOUSANDS = r"[0-9]{1,3}(?: [0-9]{3})+"
SIGN = "[−–—+-]"
UNIT = r" ?\[[^\[\]]*\]"
MARKS = "[A-Za-z]{1,3}"
NUMBER = f"{SIGN}?(?:{THOUSANDS}|{DIGITS})(?: ?{DIGITS})?(?:{UNIT})?(?:{MARKS})?"
RANGE = f"{SIGN}?{DIGITS} ?[–—-] ?{DIGITS}(?:{MARKS})?"
GAP = r"\. ?\. ?\."
VALUE = f"^(?:{RANGE}|{NUMBER}|{GAP})$"
#: Several words that are one: thousands and a unit, a whole number and a fraction, a share that follows an element.
FRACTION = "[0-9]+ [0-9]+ ?[⁄/] ?[0-9]+"
SHARE = f"[0-9]+ ?[×xX] ?[A-Za-z]{{1,2}} [tT][oO] {DIGITS}"
TOKEN = f"{SIGN}?(?:{FRACTION}|{SHARE}|{THOUSANDS}(?:{UNIT})?|{GAP})[^ ]*|[^ ]*[0-9]{UNIT}[^ ]*|[^ ]+"


def tokens(c: Column) -> Column:
    """Words of a printed row, where ``48 000 [330]``, ``1 1/2`` and the like stay one word."""
    return F.regexp_extract_all(F.coalesce(squeeze(c), F.lit("")), F.lit(TOKEN), F.lit(0))


def is_value(token: Column) -> Column:
    return squeeze(token).rlike(VALUE)


def are_values(words: Column) -> Column:
    """For each of a row's words (as ``tokens`` gives them) whether it is a value."""
    return F.transform(words, lambda x: x.rlike(VALUE))


def trailing_values(words: Column) -> Column:
    """How many words at the end are values, without a gap."""
    first_other = F.array_position(F.reverse(are_values(words)), False).cast("int")
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(words))


def split_words(words: Column, columns: Column) -> Column:
    """A label and ``columns - 1`` values from the right, or null if the last words aren't all values."""
    n = F.size(words)
    label = F.array_join(F.slice(words, F.lit(1), F.greatest(n - (columns - 1), F.lit(0))), " ")
    values = F.slice(words, F.greatest(n - (columns - 2), F.lit(1)), F.greatest(columns - 1, F.lit(0)))
    return F.when((columns > 1) & (n >= columns) & F.forall(values, lambda x: x.rlike(VALUE)), F.concat(F.array(label), values))


def split_by_count(c: Column, columns: int) -> Column:
    """``split_words`` of a text."""
    return split_words(tokens(c), F.lit(columns))


#: Names of the elements that have a column, and their symbols. Some have two names or spellings.
ELEMENTS = {
    "boron": "B", "carbon": "C", "nitrogen": "N", "aluminum": "Al", "aluminium": "Al", "silicon": "Si", "phosphorus": "P",
    "phosphorous": "P", "sulfur": "S", "sulphur": "S", "titanium": "Ti", "vanadium": "V", "chromium": "Cr",
    "manganese": "Mn", "iron": "Fe", "cobalt": "Co", "nickel": "Ni", "copper": "Cu", "zinc": "Zn", "zirconium": "Zr",
    "niobium": "Nb", "columbium": "Nb", "molybdenum": "Mo", "tin": "Sn", "tantalum": "Ta", "tungsten": "W", "lead": "Pb",
}
#: Elements, and sums of elements, that tables name and that have no column.
OTHER_ELEMENTS = (
    "hydrogen", "lithium", "beryllium", "oxygen", "fluorine", "sodium", "magnesium", "chlorine", "potassium", "calcium",
    "scandium", "gallium", "germanium", "arsenic", "selenium", "strontium", "yttrium", "ruthenium", "palladium", "silver",
    "cadmium", "indium", "antimony", "tellurium", "barium", "lanthanum", "cerium", "hafnium", "rhenium", "platinum", "gold",
    "thallium", "bismuth", "rare earth", "cerium plus lanthanum", "iron plus silicon", "silicon plus iron",
)


def element(label: Column) -> Column:
    """Symbol of the element that a label names, by its whole name or its exact symbol; OTHER for an element without a
    column of its own; null for all other labels, as ``Grade`` or ``Carbon equivalent``. Qualifiers and brackets don't count."""
    name = label_and_qualifier(label)["label"]
    symbols = sorted(set(ELEMENTS.values()))
    table = F.create_map(*[F.lit(x) for pair in ELEMENTS.items() for x in pair])
    return F.coalesce(F.when(name.isin(*symbols), name), F.try_element_at(table, F.lower(name)), F.when(F.lower(name).isin(*OTHER_ELEMENTS), F.lit("OTHER")))


#: Parts of a label by which a property is known; the first property that has one counts.
PROPERTIES = {
    "tensile": ("tensile strength", "tensile str", "ultimate tensile"),
    "yield": ("yield strength", "yield point", "yield str"),
    "elongation": ("elongation",),
    "reduction_of_area": ("reduction of area", "reduction in area"),
    "hardness": ("hardness", "brinell", "rockwell", "vickers"),
}


def property_of(label: Column) -> Column:
    """The property that a label names, null if none."""
    low = F.lower(label_and_qualifier(label)["label"])
    return F.coalesce(*[F.when(low.rlike("|".join(parts)), F.lit(name)) for name, parts in PROPERTIES.items()])


def gauge_base(label: Column) -> Column:
    """The length over which a label says that something was measured (``in 2 in. [50 mm]`` has ``2 in. [50 mm]``), else
    null: without it an elongation compares with nothing."""
    length = r"[0-9][0-9 /⁄.]*in\b\.?[^,]*"
    return squeeze(F.nullif(F.regexp_extract(squeeze(label), rf"(?i)\bin ({length})", 1), F.lit("")))


def center_sample(c: Column, width: int = 40) -> Column:
    """``width`` characters from the middle of the unspaced text; null if it is shorter."""
    flat = unspaced(c)
    return F.when(F.length(flat) >= width, F.substr(flat, ((F.length(flat) - width) / 2).cast("int") + 1, F.lit(width)))


@F.pandas_udf(StringType())
def without_accents(s: pd.Series) -> pd.Series:
    """Letters without their marks, for which SQL has no function."""
    bare = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return s.map(lambda x: None if x is None else bare(x))


def plain_key(c: Column) -> Column:
    """Capitals without accents and white space, for comparisons."""
    return F.upper(unspaced(without_accents(c)))


def is_ellipsis(c: Column) -> Column:
    return F.trim(c).rlike(r"^(?:\.{3,}|…|(?:\. ){2,}\.)$")


#: The qualifiers. Letters of notes may be printed against one (``maxC``).
QUALIFIERS = ("maximum", "minimum", "max", "min")
QUALIFIER = rf"\b({'|'.join(QUALIFIERS)})[A-Z]{{0,3}}\b"


def label_and_qualifier(c: Column) -> Column:
    """A label without brackets and punctuation, and the first qualifier that it has: max or min."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"\[[^\]]*\]|\([^)]*\)", " ")
    found = F.substring(F.lower(F.regexp_extract(bare, f"(?i){QUALIFIER}", 1)), 1, 3)
    rest = F.regexp_replace(bare, f"(?is)^(.*?){QUALIFIER}", "$1 ")
    return F.struct(F.coalesce(squeeze(F.regexp_replace(rest, r"[,:;.]+", " ")), F.lit("")).alias("label"), F.nullif(found, F.lit("")).alias("qualifier"))


def note_mark(c: Column) -> Column:
    """The mark with which a note begins: ``(1)``, a letter or a star."""
    return F.nullif(F.regexp_extract(c, r"^\s*(\(\w{1,3}\)|[A-Z](?= )|\*+)", 1), F.lit(""))


def split_heading(c: Column, n: int) -> Column:
    """Exactly ``n`` names, each with a capital or a digit in front, or null."""
    found = F.regexp_extract_all(c, F.lit(r"([A-Z0-9][^A-Z0-9]*)"), F.lit(1))
    return F.when(F.size(found) == n, F.transform(found, lambda x: F.trim(x)))


def from_latex(c: Column) -> Column:
    """Formula marks of recognised text as plain text."""
    out = F.regexp_replace(c, r"\\(?:mathrm|text|mathbf)\s*\{([^{}]*)\}", "$1")
    out = F.regexp_replace(out, r"\\frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", "$1/$2")
    for name, mark in ((r"\\times", "×"), (r"\\leq?", "≤"), (r"\\geq?", "≥"), (r"\\pm", "±"), (r"\\deg(?:ree)?", "°")):
        out = F.regexp_replace(out, name + r"(?![a-z])", mark)
    return squeeze(F.regexp_replace(out, r"[${}\\]", ""))


def clean_value(c: Column) -> Column:
    """A cell without stray ellipses and with its slash, and what was changed (null: nothing)."""
    bare = squeeze(F.regexp_replace(c, r"(?:\.{3}|…)\s*(?=\S)|(?<=\S)\s*(?:\.{3}|…)$", ""))
    joined = F.regexp_replace(bare, r"(?<=\d)\s*[∕⁄]\s*(?=\d)", "/")
    change = F.when(~joined.eqNullSafe(bare), "SLASH").when(~bare.eqNullSafe(squeeze(c)), "ELLIPSIS")
    return F.struct(joined.alias("value"), change.alias("change"))


def merged_name(c: Column) -> Column:
    """``N02200 222``: a designation and the number that was printed against it."""
    return F.struct(F.nullif(F.regexp_extract(c, r"^([A-Z]\d{5})", 1), F.lit("")).alias("name"), F.regexp_extract(c, r"^[A-Z]\d{5}\s+(\S+)$", 1).try_cast("double").alias("value"))


def numbered_notes(c: Column) -> Column:
    """Notes of a run-on text: a mark ``(n)`` begins note n only if n is the next number, so a reference to an
    earlier note stays in its sentence."""
    parts = F.split(c, r"(?=\(\d{1,3}\))")
    number = lambda p: F.regexp_extract(p, r"^\((\d{1,3})\)", 1).try_cast("int")

    def step(notes: Column, part: Column) -> Column:
        last = F.element_at(notes, -1)
        begins = number(part) == F.size(notes) + 1
        grown = F.concat(F.slice(notes, 1, F.size(notes) - 1), F.array(F.concat(last, part)))
        return F.when(begins, F.concat(notes, F.array(part))).when(F.size(notes) > 0, grown).otherwise(notes)

    return F.transform(F.aggregate(parts, F.array().cast("array<string>"), step), lambda x: F.trim(F.regexp_replace(x, r"^\(\d{1,3}\)", "")))


def unique_names(names: list[str]) -> list[str]:
    """Field names from printed headers: letters and digits, each once."""
    import re

    out: list[str] = []
    for name in names:
        base = re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_") or "column"
        k, own = 1, base
        while own in out:
            k, own = k + 1, f"{base}_{k + 1}"
        out.append(own)
    return out


# ---- titles and names of documents ----


#: Words after a composition that aren't part of it, and the two spellings of one nickel steel.
STEEL_WORDS = r"(?i)\s*\bsteels?\b|\s*\balloys?\b"


def compositions_of(title: Column) -> Column:
    """Keys of the compositions that a column's title names (``12Cr, 12Cr-1Al, and 13Cr Steels`` has three), in
    the order in which they are printed. Numbered groups name none."""
    bare = F.regexp_replace(F.regexp_replace(title, r"(?i)^coefficients for\s+|\([^)]*\)|\[[^\]]*\]", " "), r"\s+[ABC]\s*$", "")
    named = F.regexp_replace(bare, r"(\d+)\s*%\s*Nickel", "$1Ni")
    parts = F.split(F.regexp_replace(named, STEEL_WORDS, " "), r"\s*,\s*(?:and\s+)?|\s+and\s+")
    keys = F.transform(parts, lambda x: composition_key(x))
    return F.filter(keys, lambda k: k.rlike(r"^\d+(?:\.\d+)?[A-Z]"))


def condition_of(title: Column) -> Column:
    """What a title says in parentheses about its column, numbered groups aside; null if nothing."""
    found = F.regexp_extract_all(title, F.lit(r"\(([^)]*)\)"), F.lit(1))
    said = F.filter(found, lambda x: ~x.rlike(r"(?i)^(?:group \d+|note)") & ~x.rlike(r"^\d+$"))
    return F.get(said, F.lit(0))


def treatment_of(title: Column) -> Column:
    """The number of the heat treatment that a title names, else null."""
    return F.nullif(F.regexp_extract(title, r"Condition\s+H?(\d+)", 1), F.lit(""))


def series_label(title: Column) -> Column:
    """Name of the group that a title's B column holds: its numbered group, else its text; null for other columns
    and for a bare letter."""
    bare = F.regexp_replace(title, r"\s*\[[^\]]*\]", "")
    body = F.regexp_extract(bare, r"^(.*\S)\s+B$", 1)
    group = F.regexp_extract(body, r"\((Group \d+)\)", 1)
    return F.when(body != "", F.when(group != "", group).otherwise(body))


def field_name(title: Column) -> Column:
    """Snake-case key of a printed header, without its bracketed notes."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(title, r"\[[^\]]*\]", "")), r"[^a-z0-9]+", "_"), F.lit("_"))


def designations(names: list[Column], title: Column) -> Column:
    """Loose forms under which a document may be named: its names, what its title has before `` - ``, and the parts
    of these between slashes and commas."""
    head = F.when(title.contains(" - "), F.split_part(title, F.lit(" - "), F.lit(1)))
    every = F.filter(F.array(*[F.trim(n) for n in names], F.trim(head)), lambda x: F.coalesce(x, F.lit("")) != "")
    parts = F.filter(F.flatten(F.transform(every, lambda x: F.split(x, "[/,]"))), lambda x: F.length(F.trim(x)) > 3)
    return F.array_distinct(F.filter(F.transform(F.concat(every, parts), plain), lambda x: x != ""))


def plain(c: Column) -> Column:
    """Capitals without white space."""
    return F.upper(unspaced(c))


def printed_numbers(page: Column) -> Column:
    """Numbers of up to four digits in the first two and the last two lines of a page: one of them is its folio."""
    lines = F.filter(F.transform(F.split(F.coalesce(page, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    ends = F.concat(F.slice(lines, 1, 2), F.slice(lines, F.greatest(F.size(lines) - 1, F.lit(1)), F.lit(2)))
    found = F.flatten(F.transform(ends, lambda x: F.regexp_extract_all(x, F.lit(r"\b(\d{1,4})\b"), F.lit(1))))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: x.cast("int"))))


def file_prefix(specification: Column, title: Column) -> Column:
    """How a document's file name begins: its specification, or its title, in small letters and digits."""
    name = F.coalesce(F.split_part(F.nullif(specification, F.lit("")), F.lit(" - "), F.lit(1)), title, F.lit(""))
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


# ---- raw rows of recognised pages ----


def is_header_row(html: Column) -> Column:
    """A row of header cells, which every page of a table repeats."""
    return F.coalesce(html.contains("<th"), F.lit(False))


def is_group_row(cells: Column, html: Column) -> Column:
    """A heading within a table: one spanning cell, or a first cell with nothing beside it."""
    filled = F.get(cells, F.lit(0)) != ""
    rest = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    alone = (F.size(cells) == 1) & html.contains("colspan")
    return F.coalesce(filled & (alone | ((F.size(cells) > 1) & F.forall(rest, lambda x: F.coalesce(x, F.lit("")) == ""))), F.lit(False))


def coefficient(line: Column) -> Column:
    """name, quantity and unit of a line ``A = quantity, unit`` (a closing brace is no part of it), else null."""
    pattern = r"^([AB])\s*=\s*(.+?),\s*([^,}]+?)\s*(?:\}.*)?$"
    part = lambda k: F.trim(F.regexp_extract(line, pattern, k))
    return F.when(line.rlike(pattern), F.struct(part(1).alias("name"), part(2).alias("quantity"), part(3).alias("unit")))


def has_signature(c: Column, marks: list[str]) -> Column:
    """Whether a block's text has all the marks by which it is known, wherever it stands."""
    return F.coalesce(F.forall(F.array(*map(F.lit, marks)), lambda m: c.contains(m)), F.lit(False))


def comparison_key(c: Column) -> Column:
    """``356.0`` and ``356`` are the same key; text is compared trimmed."""
    number = F.trim(c).try_cast("double")
    whole = number == F.floor(number)
    return F.coalesce(F.when(whole & (F.abs(number) < 1e15), number.cast("long").cast("string")), number.cast("string"), F.trim(c), F.lit(""))


def mentions_number(c: Column, number: Column) -> Column:
    """Whether a text has the number as a word of its own."""
    return F.array_contains(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d+"), F.lit(0)), number.cast("string"))
