"""Scalar text functions built from native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X

# What counts as white space at the edge of a value, and as a line end.
WHITESPACE = (
    " \t\n\u000b\u000c\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
OTHER_LINE_ENDS = "\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c, characters: str = WHITESPACE) -> Column:
    return F.trim(col(c), F.lit(characters))


def squeeze(c) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def one_line_end(c) -> Column:
    """Every line end becomes a line feed. The rewrite runs only on texts that
    hold another line end, since looking for one is much cheaper."""
    found = F.contains(col(c), F.lit(OTHER_LINE_ENDS[0]))
    for end in OTHER_LINE_ENDS[1:]:
        found = found | F.contains(col(c), F.lit(end))
    return F.when(found, F.regexp_replace(col(c), f"\r\n|[{OTHER_LINE_ENDS}]", "\n")).otherwise(col(c))


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def regex_quote(term: str) -> str:
    return r"\Q" + term + r"\E"


def extract(c, pattern: str, group: int = 1) -> Column:
    """First match or null; the built-in returns an empty string for both."""
    return F.when(F.regexp_like(col(c), F.lit(pattern)),
                  F.regexp_extract(col(c), pattern, group))


def to_int(c) -> Column:
    """Whole number or null; values past the range saturate."""
    wide = "decimal(38,0)"
    whole = F.when(F.regexp_like(strip(c), F.lit(r"^[+-]?\d+$")), strip(c).try_cast(wide))
    low, top = F.lit(-2147483648).cast(wide), F.lit(2147483647).cast(wide)
    return F.when(whole.isNotNull(), F.greatest(low, F.least(top, whole)).cast("int"))


def case_folded(c) -> Column:
    """Text in which every letter that a pattern without case takes for one of
    a-z stands as that letter."""
    return F.lower(F.translate(col(c), "\u0130\u0131\u017f\u212a", "iisk"))


def first_group(c, label: str, pattern: str, folded=None) -> Column:
    """First group of a pattern that holds a label, or null. Given the folded
    text, the pattern runs only where the label occurs at all: looking for it
    is much cheaper."""
    hit = F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit(""))
    # a last letter that may be missing is not looked for
    return hit if folded is None else F.when(F.contains(col(folded), F.lit(label[:-2] if label.endswith("?") else label)), hit)


def digits_after(c, labels: list[str], folded=None) -> Column:
    """Digits that follow the first label found, as text."""
    return F.coalesce(*[
        first_group(c, label, rf"(?iU)\b{label}\b\s*(?:is\b|=|:)?\s*(\d+)", folded) for label in labels])


def number_after(c, labels: list[str]) -> Column:
    """Whole number that follows the first label found: `level is 7`, `hp=42`."""
    return to_int(digits_after(c, labels))


def labelled_pairs(c) -> Column:
    """`key: value` / `key = value` pairs as an array of (key, value), in text order.

    Keys are lower-cased with underscores; empty values are left out.
    """
    # the search costs most, so it runs once, and only where there is a mark
    found = F.regexp_extract_all(col(c), F.lit(X.PAIR_PATTERN), F.lit(0))
    pairs = F.transform(found, lambda p: F.struct(
        key_slug(F.regexp_extract(p, X.PAIR_PARTS, 1)).alias("key"),
        strip(F.regexp_extract(p, X.PAIR_PARTS, 2), X.EDGE_PUNCTUATION).alias("value")))
    kept = F.filter(pairs, lambda p: p["value"] != "")
    marked = F.contains(col(c), F.lit(":")) | F.contains(col(c), F.lit("="))
    return F.when(~marked, F.array().cast("array<struct<key:string,value:string>>")).otherwise(kept)


def last_per_key(pairs: Column) -> Column:
    """Map from (key, value) pairs where a repeated key keeps its last value."""
    return F.aggregate(
        F.transform(pairs, lambda p: F.map_from_entries(F.array(p))),
        F.create_map().cast("map<string,string>"),
        lambda acc, one: F.map_concat(
            F.map_filter(acc, lambda k, v: ~F.map_contains_key(one, k)), one),
    )


def text_after(c, labels: list[str], stops: list[str] | None = None, folded=None) -> Column:
    """Text that follows the first label found, up to a stop word or the end."""
    ends = "|".join(regex_quote(s) for s in (stops or X.VALUE_STOP_WORDS))
    hits = [
        first_group(
            c, label, rf"(?iU)\b{label}\b\s*(?:is\b|=|:)?\s*([A-Za-z][A-Za-z' -]{{1,40}}?)(?=\s+(?:{ends})\b|$)", folded)
        for label in labels
    ]
    return strip(F.coalesce(*hits), X.EDGE_PUNCTUATION)


def wielded(c, folded=None) -> Column:
    """What follows `wields a ...`."""
    return strip(first_group(c, "wields?", X.WIELD_PATTERN, folded), X.EDGE_PUNCTUATION)


def title(c) -> Column:
    """Every run of letters gets one leading capital (`O'Neil`, `Half-Orc`)."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(?s)(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.concat(
        F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))), "")


def clean_name(c) -> Column:
    """At most three words of a name, without lead-in words or trailing clauses."""
    name = strip(strip(c), X.NAME_EDGE_PUNCTUATION)
    name = F.regexp_replace(name, r"(?iU)^(?:named|called|name|namens|heisst)\s+", "")
    name = F.regexp_replace(name, r"(?s)[,.;:].*$", "")
    stops = "|".join(X.NAME_STOP_WORDS)
    name = F.regexp_replace(name, rf"(?isU)\b(?:{stops})\b.*$", "")
    words = F.slice(F.regexp_extract_all(name, F.lit(r"([A-Za-z][A-Za-z'-]*)"), F.lit(1)), 1, 3)
    return blank_to_null(F.array_join(F.transform(words, title), " "))


def name_hint(c) -> Column:
    """Name announced in a prompt, cleaned."""
    return F.coalesce(*[
        clean_name(F.nullif(F.regexp_extract(col(c), p, 1), F.lit(""))) for p in X.NAME_HINT_PATTERNS
    ])


def norm_phrase(c) -> Column:
    """Lower-case words of letters, digits and apostrophes, one space apart."""
    return F.array_join(F.regexp_extract_all(F.lower(col(c)), F.lit(r"([a-z0-9']+)"), F.lit(1)), " ")


def key_slug(c) -> Column:
    return F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))


def slug(c) -> Column:
    return F.trim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def stringify_json(c) -> Column:
    """Text of one JSON value: arrays become comma-separated items. A text that
    only starts like an array is plain text."""
    items = F.from_json(col(c), "array<string>")
    kept = F.filter(F.transform(items, lambda i: strip(i)), lambda i: i != "")
    is_array = strip(c).startswith("[") & items.isNotNull()
    return F.when(is_array, F.array_join(kept, ", ")).otherwise(strip(c))


def first_json_object(c) -> Column:
    """First balanced `{...}` in a text, aware of strings and escapes; else null."""
    text = col(c)
    state = "struct<at:int,start:int,stop:int,depth:int,quoted:boolean,escaped:boolean>"
    zero = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("start"), F.lit(0).alias("stop"),
        F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"),
    ).cast(state)

    def step(s, ch):
        live = (s["start"] > 0) & (s["stop"] == 0)
        plain = live & ~s["quoted"]
        opens = (ch == "{") & (s["stop"] == 0) & ((s["start"] == 0) | ~s["quoted"])
        closes = plain & (ch == "}")
        at = s["at"] + 1
        depth = s["depth"] + opens.cast("int") - closes.cast("int")
        quoted = F.when(live & (ch == '"') & ~s["escaped"], ~s["quoted"]).otherwise(s["quoted"])
        escaped = live & s["quoted"] & (ch == "\\") & ~s["escaped"]
        return F.struct(
            at.alias("at"),
            F.when((s["start"] == 0) & opens, at).otherwise(s["start"]).alias("start"),
            F.when(closes & (depth == 0), at).otherwise(s["stop"]).alias("stop"),
            depth.alias("depth"), quoted.alias("quoted"), escaped.alias("escaped"),
        ).cast(state)

    def finish(s):
        return F.when(s["stop"] > 0, F.struct(s["start"].alias("start"), s["stop"].alias("stop")))

    span = F.aggregate(F.split(text, ""), zero, step, finish)
    # the span is bound to one lambda variable, so the scan runs once
    found = F.transform(F.array(span), lambda s: text.substr(s["start"], s["stop"] - s["start"] + 1))
    return F.when(F.contains(text, F.lit("{")), F.get(found, F.lit(0)))


def parse_object(c) -> Column:
    """Top-level members of a JSON object as text, or null when it is not one."""
    return F.from_json(col(c), "map<string,string>")


def extract_answer(c) -> Column:
    """Text between the first answer mark and the next end mark, stripped."""
    text = col(c)
    at = F.instr(text, X.ANSWER_MARK)
    rest = text.substr(at + len(X.ANSWER_MARK), F.length(text))
    return F.when(at > 0, strip(F.substring_index(rest, X.END_MARK, 1)))


def prompt_of(c) -> Column:
    """Example text up to and including the answer mark."""
    return F.concat(F.substring_index(col(c), X.ANSWER_MARK, 1), F.lit(X.ANSWER_MARK + " "))


def norm_label(c) -> Column:
    return F.upper(squeeze(c))


def word_syllables(word: Column) -> Column:
    bare = F.regexp_replace(F.lower(word), "[^a-z]", "")
    groups = F.regexp_count(bare, F.lit("[aeiouy]+"))
    silent = (F.endswith(bare, F.lit("e")) & (groups > 1)).cast("int")
    return F.when(bare == "", 0).otherwise(F.greatest(groups - silent, F.lit(1)))


def syllables(c) -> Column:
    """Estimated syllables of a line: sum over its words."""
    words = F.split(squeeze(c), " ")
    return F.aggregate(words, F.lit(0), lambda acc, w: acc + word_syllables(w))


def norm_speaker(c) -> Column:
    """Speaker name without its final mark, squeezed, upper case."""
    return F.upper(squeeze(F.regexp_replace(col(c), "[:.]$", "")))


def preview(c, characters: int = 240) -> Column:
    return F.translate(F.substring(col(c), 1, characters), "\n", " ")


def traits_text(c, between: str = "; ") -> Column:
    """`key: value` text of a map, keys sorted because map order is no contract."""
    entries = F.array_sort(F.map_entries(col(c)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), between)


def fill(template: str, values: dict[str, Column]) -> Column:
    """Replace `{field}` parts of a template by columns."""
    parts, rest = [], template
    while "{" in rest:
        head, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        if head:
            parts.append(F.lit(head))
        parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)
