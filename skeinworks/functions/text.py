"""Text functions of the thread builder, as column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the hosts of links to posts, white space, labels and their keys
HOSTS = ("farcaster.xyz", "warpcast.com")
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
THREAD_TYPES = (
    "creation-showcase", "project-update", "advice-giving", "question-seeking", "life-update",
    "opinion-stating", "ritual-greeting", "call-to-action", "market-alert", "noise",
)
VALUE_EXCHANGES = ("knowledge-transfer", "social-capital", "emotional-energy", "economic-value", "none")
INTERACTION_PATTERNS = ("problem-solving", "social-bonding", "show-and-tell", "information-seeking", "debate")
LABELS = {"thread_type": THREAD_TYPES, "value_exchange": VALUE_EXCHANGES, "interaction_pattern": INTERACTION_PATTERNS}


def byte_to_char(text: Column, at: Column) -> Column:
    """The character offset of a UTF-8 byte offset; inside a character, that of the next one; behind the end, the length."""
    raw = F.encode(text, "UTF-8")
    # continuation bytes from the offset on are skipped, three at most
    more = lambda n: F.conv(F.hex(F.substring(raw, at + n + 1, F.lit(1))), 16, 10).cast("int").between(128, 191)
    skip = F.when(~F.coalesce(more(0), F.lit(False)), 0).when(~F.coalesce(more(1), F.lit(False)), 1).when(~F.coalesce(more(2), F.lit(False)), 2).otherwise(3)
    return F.when(at <= 0, 0).when(at >= F.octet_length(text), F.length(text)).otherwise(F.length(F.decode(F.substring(raw, F.lit(1), at + skip), "UTF-8")))


def inject(text: Column, mentions: Column) -> Column:
    """Puts each tag into the text; mentions: an array of struct(pos, tag) sorted by place, one a tag."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda s, m: F.struct(m["pos"].alias("at"), F.concat(s["out"], F.substring(text, s["at"] + 1, m["pos"] - s["at"]), m["tag"]).alias("out"))
    return F.aggregate(mentions, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def tail(text: Column, urls: Column) -> Column:
    """The urls that the text lacks, whatever their case, sorted, each after a space."""
    lost = F.array_sort(F.array_distinct(F.filter(urls, lambda u: u.isNotNull() & (F.instr(F.lower(text), F.lower(u)) == 0))))
    return F.when(F.size(lost) > 0, F.concat(F.lit(" "), F.array_join(lost, " "))).otherwise(F.lit(""))


def tidy(text: Column, hosts: tuple[str, ...] = HOSTS) -> Column:
    """One of repeated tags, no links to posts of our own hosts, no line breaks."""
    once = F.regexp_replace(text, r"(@[A-Za-z0-9._]+)\1+", "$1")
    link = "https://(" + "|".join(h.replace(".", r"\.") for h in hosts) + r")/[^/]+/0x[a-fA-F0-9]+"
    return F.regexp_replace(F.regexp_replace(once, link, ""), "[\n\r\t]+", " ")


def line(depth: Column, username: Column, text: Column) -> Column:
    level = F.when(depth > 0, F.concat(F.lit("~"), depth.cast("string"), F.lit(": ")))
    return F.concat_ws("", level, F.lit("@"), username, F.lit(": "), text)


#: A mention ends where a word does, or begins.
MENTION = r"@[a-z0-9_.-]+(?:(?<=[a-z0-9_])(?![\p{L}\p{N}_])|(?<=[.-])(?=[\p{L}\p{N}_]))"


def normalise(text: Column) -> Column:
    """What near-duplicate detection compares: lower case, without a leading name, mentions, links and signs, one space between words."""
    t = F.lower(F.coalesce(text, F.lit("")))
    # most texts hold neither, and need no search
    t = F.when(t.contains("@"), F.regexp_replace(F.regexp_replace(t, rf"^@[a-z0-9_.-]+:[{SPACE}]*", ""), MENTION, "")).otherwise(t)
    t = F.when(t.contains("://"), F.regexp_replace(t, rf"https?://[^{SPACE}]+", "")).otherwise(t)
    t = F.trim(F.regexp_replace(t, f"[{SPACE}]+", " "))
    return F.regexp_replace(t, r"[^\p{L}\p{N}_ #]+", "")


def char_shingles(text: Column, n: int = 3) -> Column:
    short = F.array_distinct(F.concat(F.filter(F.split(text, r"\s+"), lambda w: w != ""), F.array(text)))

    def grams(chars: Column) -> Column:
        first = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - n + 1, F.lit(0)))
        return F.array_distinct(F.transform(first, lambda c, i: F.concat(c, *[F.get(chars, i + k) for k in range(1, n)])))

    # cut into characters once: a substring would walk through the text for each place
    long = F.get(F.transform(F.array(F.split(text, "")), grams), F.lit(0))
    return F.when(F.length(text) < n, short).otherwise(long)


def embed_text(text: Column) -> Column:
    """Null for blank texts, else with plain reply marks."""
    return F.when(F.length(F.trim(text)) > 0, F.replace(text, F.lit("↳"), F.lit("-")))


def pretoken_count(text: Column) -> Column:
    """Tokens by a plain rule: runs of letters, runs of digits, single other signs."""
    return F.when(text.isNotNull(), F.regexp_count(text, F.lit(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\s]")))


def longest(*candidates: Column) -> Column:
    """The longest string that is not null; of equals the first."""
    some = F.filter(F.array(*[F.struct(F.length(c).alias("n"), F.lit(-i).alias("i"), c.alias("v")) for i, c in enumerate(candidates)]), lambda s: s["v"].isNotNull())
    return F.when(F.size(some) > 0, F.array_max(some)["v"])


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def parse_labels(answer: Column, vocabulary: dict[str, tuple[str, ...]] = LABELS) -> dict[str, Column]:
    """The labels of an answer. A line belongs to the first key that it holds, if it holds a colon; what stands behind the first colon
    counts if it is in the vocabulary; of several the last. Null where no line has a valid value."""
    lines = F.split(F.lower(stripped(answer)), "\n")
    keys = list(vocabulary)
    return {k: _last(_values(lines, k, keys[:i], vocabulary[k])) for i, k in enumerate(keys)}


def _values(lines: Column, key: str, before: list[str], known: tuple[str, ...]) -> Column:
    def mine(line: Column) -> Column:
        return functools.reduce(lambda c, k: c & ~line.contains(k), before, line.contains(key) & line.contains(":"))

    values = F.transform(F.filter(lines, mine), lambda x: stripped(F.substring(x, F.instr(x, ":") + 1, F.length(x))))
    return F.filter(values, lambda v: v.isin(*known))


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def prompt(text: Column, vocabulary: dict[str, tuple[str, ...]] = LABELS, template: str | None = None) -> Column:
    """The question that a classifier is asked: the labels to choose from, the text, and the lines to answer with. A template holds
    {labels}, {text} and {answer}."""
    template = template or "Choose one label of each list for the thread below. Its first post counts most.\n\n{labels}\n\nThread:\n{text}\n\nAnswer with these lines only:\n{answer}"
    labels = "\n".join(f"{k}: {', '.join(v)}" for k, v in vocabulary.items())
    filled = template.replace("{labels}", labels).replace("{answer}", "\n".join(f"{k}:<label>" for k in vocabulary))
    head, _, end = filled.partition("{text}")
    return F.concat(F.lit(head), embed_text(text), F.lit(end))


def from_hex(text: Column) -> Column:
    return F.unhex(text)


def to_hex(raw: Column) -> Column:
    """Lower-case hex digits of bytes."""
    return F.lower(F.hex(raw))


def bytes_of(numbers: Column) -> Column:
    """An array of numbers from 0 to 255 as bytes."""
    return F.unhex(F.array_join(F.transform(numbers, lambda n: F.lpad(F.hex(n.cast("long")), 2, "0")), ""))


def embedded_hash(embeds: Column) -> Column:
    """The bytes listed behind the first 'hash': {'data': [ in a post's pseudo-JSON; null where none are."""
    found = F.regexp_extract(embeds, r"'hash'\s*:\s*\{'data'\s*:\s*\[([0-9,\s]+)\]", 1)
    return F.when(F.length(found) > 0, bytes_of(F.transform(F.split(found, ","), lambda n: F.trim(n).cast("int"))))


def with_quote(text: Column, quote: Column) -> Column:
    """The quote in the place of links to posts, or behind the text where it has none; the text alone without a quote."""
    link = r"https://warpcast\.com/[^ ]+/0x[0-9A-Fa-f]{8,}"
    safe = F.replace(F.replace(quote, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.when(quote.isNull(), text).when(text.rlike(link), F.regexp_replace(text, F.lit(link), safe)).otherwise(F.concat_ws("", text, F.lit(" "), quote))
