"""Text expressions: normalisation, keys, templates, formatted numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadtide.functions.scores import round_to

# The code points with the Unicode White_Space property.
WHITESPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def normalise(text) -> Column:
    """Lower-case, then strip surrounding whitespace of any kind.

    Trimming by a list of characters is slow, so it runs only where, after plain blanks
    are gone, an end is below ``!`` or above ASCII: other whitespace lies there.
    """
    plain = F.trim(F.lower(text))
    low, high = F.lit("!"), F.lit("\u0085")
    last = F.substring(plain, -1, 1)
    suspect = (plain < low) | (plain >= high) | (last < low) | (last >= high)
    return F.when(suspect, F.btrim(plain, F.lit(WHITESPACE))).otherwise(plain)


def packed(*texts) -> Column:
    """One text for several, which tells them apart and compares as they do one by one, NULL first.

    NULL is 0; another text is 1, the text and 0.  In it 0 is written as 1 1 and 1 as 1 2.
    """
    zero, one = F.lit("\u0000"), F.lit("\u0001")

    def part(text) -> Column:
        plain = F.replace(F.replace(text, one, F.lit("\u0001\u0002")), zero, F.lit("\u0001\u0001"))
        return F.coalesce(F.concat(one, plain, zero), zero)

    return F.concat(*[part(F.col(t) if isinstance(t, str) else t) for t in texts])


def unpacked(text: Column, count: int) -> list[Column]:
    """The ``count`` texts of ``packed``."""
    zero, one = F.lit("\u0000"), F.lit("\u0001")

    def part(number: int) -> Column:
        whole = F.split_part(text, zero, F.lit(number))
        plain = F.replace(F.replace(whole.substr(2, 2**31 - 1), F.lit("\u0001\u0001"), zero), F.lit("\u0001\u0002"), one)
        return F.when(whole != "", plain)

    return [part(n) for n in range(1, count + 1)]


def dedup_key(company, title, location) -> Column:
    """Readable posting key; grouping uses the three columns, so ``|`` cannot collide."""
    return F.concat_ws("|", company, title, F.coalesce(location, F.lit("")))


def posting_key(company, title, posting_date, ordinal) -> Column:
    """First 16 hex digits of SHA-256 over the underscore-joined parts."""
    joined = F.concat_ws(
        "_", company, title, F.date_format(posting_date, "yyyy-MM-dd"), F.col(ordinal).cast("string")
    )
    return F.substring(F.sha2(joined, 256), 1, 16)


def posting_url(key) -> Column:
    return F.concat(F.lit("https://example.com/jobs/"), key)


def posting_text(company, title, techs, skills=(), benefits=(), place="") -> Column:
    """A whole description: an opening line, then sections of requirements (the first three
    technologies, the last one as a plus, and ``skills``), technologies, benefits and place."""

    def section(head: str, lines: list[Column]) -> Column:
        return F.concat_ws("\n", F.lit(head), *[F.concat(F.lit("- "), line) for line in lines])

    required = [
        F.concat(F.lit("Strong experience with "), F.array_join(F.slice(techs, 1, 3), ", ")),
        F.concat(
            F.lit("Experience with "), F.coalesce(F.try_element_at(F.col(techs), F.lit(-1)), F.lit("")), F.lit(" is a plus")
        ),
        *map(F.lit, skills),
    ]
    return F.concat_ws(
        "\n\n",
        F.format_string("%s is hiring a %s.", F.col(company), F.col(title)),
        section("Requirements:", required),
        F.concat(F.lit("Tech Stack:\n"), F.array_join(techs, ", ")),
        section("Benefits:", [F.lit(x) for x in benefits]),
        F.lit(f"Location: {place}"),
    )


def preview(text, width: int = 30) -> Column:
    """The first ``width`` characters, with dots when something was cut."""
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(F.col(text))


def percent_text(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", round_to(value, digits))


def range_text(low: Column, high: Column) -> Column:
    return F.concat_ws(" to ", low.cast("string"), high.cast("string"))
