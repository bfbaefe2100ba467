"""String expressions: names, slugs, domains, titles, reply texts."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import fixed


# any Unicode white space, not only blanks
SPACE = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def quoted(v: str) -> str:
    """A SQL text literal."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values) -> Column:
    """A constant array, built in one call."""
    if not values:
        return F.expr("cast(array() as array<string>)")
    return F.expr("array(" + ", ".join(map(quoted, values)) + ")")


def has_text(c: Column) -> Column:
    """Null-safe: null and '' both count as missing."""
    return F.coalesce(c != F.lit(""), F.lit(False))


def has_number(c: Column) -> Column:
    """Null-safe: null and 0 both count as missing."""
    return F.coalesce(c != F.lit(0), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.when(has_text(c), c)


def first_text(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def domain_of(url: Column) -> Column:
    """Host (with port) of a URL: no scheme, path, query or leading 'www.'."""
    s = strip(F.lower(url))
    s = F.regexp_replace(s, r"(?s)^.*?://", "")
    s = F.regexp_replace(s, r"(?s)[/?].*$", "")
    return blank_to_null(F.regexp_replace(s, r"^www\.", ""))


def with_scheme(url: Column) -> Column:
    return F.when(url.rlike(r"^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def norm_name(name: Column, stop_words=fixed.SIGNAL_STOP_WORDS) -> Column:
    """Lower-case, drop company words, keep [a-z0-9] runs separated by one blank."""
    s = F.lower(F.coalesce(name, F.lit("")))
    s = F.regexp_replace(s, r"\b(" + "|".join(stop_words) + r")\b", " ")
    return F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " "))


def name_inside(norm_needle: Column, norm_text: Column) -> Column:
    """Both sides already normalised; names under 3 characters never match."""
    return F.coalesce((F.length(norm_needle) >= 3) & norm_text.contains(norm_needle), F.lit(False))


def platform_names_match(a: Column, b: Column) -> Column:
    """Containment either way, or enough common tokens. Sides normalised with PLATFORM_STOP_WORDS."""
    ta, tb = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    smaller = F.least(F.size(ta), F.size(tb))
    need = F.greatest(F.lit(1), F.floor(smaller / 2).cast("int"))
    overlap = F.size(F.array_intersect(ta, tb)) >= need
    return has_text(a) & has_text(b) & (a.contains(b) | b.contains(a) | overlap)


def slugify(s: Column, fallback: str = "nominee") -> Column:
    t = F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"[^a-z0-9]+", "-")
    t = F.substring(F.regexp_replace(t, r"^-+|-+$", ""), 1, 80)
    return F.coalesce(blank_to_null(t), F.lit(fallback))


def nominee_slug(name: Column, place_id: Column) -> Column:
    base = slugify(name)
    return F.when(has_text(place_id), F.concat_ws("-", base, F.right(place_id, F.lit(6)))).otherwise(base)


def title_core(title: Column) -> Column:
    """'Best Coffee Shop in Downtown' -> 'Coffee Shop' (last ' in ' wins)."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"^(Best )?(best )?", "")
    return F.regexp_replace(t, r"(?s)^(.*) in .*$", "$1")


def search_term(title: Column) -> Column:
    return strip(title_core(title))


def search_query(title: Column, region: Column, override: Column, suffix: str = fixed.QUERY_SUFFIX) -> Column:
    built = F.concat(search_term(title), F.lit(" in "), region, F.lit(suffix))
    return F.coalesce(blank_to_null(override), built)


def serp_query(title: Column, region: Column) -> Column:
    return F.concat(F.lit("best "), search_term(title), F.lit(" "), region)


def words(s: Column) -> Column:
    return F.regexp_extract_all(F.lower(s), F.lit(r"[a-z0-9]+"), 0)


def topic_terms(title: Column, stop_words=fixed.TOPIC_STOP_WORDS) -> Column:
    stop = text_array(stop_words)
    tokens = F.filter(words(title_core(title)), lambda t: F.length(t) >= 3)
    return F.array_except(F.array_distinct(tokens), stop)


def contains_any(lowered: Column, keywords) -> Column:
    """Substring test on lower-cased text: 'line' also hits 'online'."""
    return reduce(lambda a, b: a | b, [lowered.contains(k) for k in keywords])


def name_list(reply: Column, fallback_items: int = 10) -> Column:
    """Names out of a free-text reply: the JSON array in it, else its lines without bullets."""
    bracketed = F.regexp_extract(reply, r"(?s)\[.*\]", 0)
    parsed = F.from_json(blank_to_null(bracketed), "array<string>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    from_array = F.filter(F.transform(parsed, lambda x: strip(F.coalesce(x, F.lit("None")))), lambda x: x != "")
    lines = F.transform(
        F.split(reply, r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"),
        lambda x: strip(F.regexp_replace(x, r"^\s*[-*\d.)]+\s*", "")),
    )
    from_lines = F.slice(F.filter(lines, lambda x: x != ""), 1, fallback_items)
    return F.when(has_text(reply), F.coalesce(from_array, from_lines)).otherwise(F.array().cast("array<string>"))


def topic_ideas(reply: Column) -> Column:
    """array<struct<title,category>> out of a reply; ideas without a title are dropped."""
    bracketed = F.regexp_extract(reply, r"(?s)\[.*\]", 0)
    parsed = F.from_json(blank_to_null(bracketed), "array<struct<title:string,category:string>>",
                         {"allowSingleQuotes": "false"})
    kept = F.filter(parsed, lambda o: has_text(o["title"]))
    shaped = F.transform(
        kept,
        lambda o: F.struct(
            strip(o["title"]).alias("title"),
            strip(F.coalesce(o["category"], F.lit("food"))).alias("category"),
        ),
    )
    return F.coalesce(shaped, F.array().cast("array<struct<title:string,category:string>>"))


def snippet(text: Column, chars: int = fixed.SNIPPET_CHARS) -> Column:
    return F.translate(F.substring(strip(text), 1, chars), "\n", " ")


def epoch_seconds(ts: Column) -> Column:
    """Text to epoch: a leading YYYY-MM-DD counts as that date at midnight; else a plain number; else null."""
    date_part = F.regexp_extract(ts, r"^\d{4}-\d{2}-\d{2}", 0)
    # counted in days, so the session time zone and its clock changes do not matter
    day = F.try_to_timestamp(blank_to_null(date_part), F.lit("yyyy-MM-dd")).cast("date")
    as_date = F.unix_date(day) * F.lit(86400.0)
    return F.when(has_text(date_part), as_date).otherwise(ts.try_cast("double"))
