"""Column builders for article text.  Built-in expressions only: everything stays in the JVM."""

from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import Column, functions as F

from newsmill.functions import rules


def split_labels(col) -> Column:
    """Pipe-delimited labels -> array; null or empty text -> empty array."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(F.coalesce(col, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(col, "[|]"))


def label_tokens(col) -> Column:
    """Trimmed upper-case labels, blanks dropped."""
    return F.filter(
        F.transform(split_labels(col), lambda t: F.upper(F.trim(t))), lambda t: t != ""
    )


def lookup(mapping: dict) -> Column:
    """A literal map for small rule tables."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def whole_word(alternatives: str) -> str:
    """Case-insensitive, Unicode-aware whole-word pattern."""
    return rf"(?iuU)\b({alternatives})\b"


def name_table(by_entity: dict) -> tuple[Column, Column]:
    """(trigger words, trigger -> names): a name is found by one of its words, its longest, so that a text's distinct words meet the dictionary
    in one set operation however long it is.  A name of one word is found with it; any other has a whole-word pattern to be checked.  Names without a word have the trigger ""."""
    table: dict[str, list] = {}
    for i, (entity, name) in enumerate(by_entity.items()):
        trigger = max(re.findall(r"\w+", name), key=len, default="")
        pattern = None if trigger == name else rf"(?iuU)(?<!\w)\Q{name}\E(?!\w)"
        table.setdefault(trigger, []).append((i, entity, pattern))
    struct = lambda i, e, p: F.struct(F.lit(i).alias("i"), F.lit(e).alias("e"), F.lit(p).cast("string").alias("p"))
    return F.array(*map(F.lit, table)), F.create_map(*[x for t, own in table.items() for x in (F.lit(t), F.array(*[struct(*o) for o in own]))])


def map_entities(
    categories,
    title=None,
    body=None,
    tokens: dict | None = None,
    names: dict | None = None,
    market_categories: list | None = None,
    proxy: str | None = rules.MARKET_PROXY,
    scan_chars: int | None = None,
) -> Column:
    """Entities of an article, first-seen order: category tokens, then names in title and body (all of
    it, or its first ``scan_chars`` characters), else ``proxy`` when only market-wide categories are present (``proxy=None`` switches that off)."""
    tokens = rules.CATEGORY_ENTITIES if tokens is None else tokens
    names = rules.NAME_ENTITIES if names is None else names
    market = rules.MARKET_CATEGORIES if market_categories is None else market_categories
    toks = label_tokens(categories)
    table = lookup(tokens)
    found = F.array_distinct(
        F.filter(F.transform(toks, lambda t: F.element_at(table, t)), lambda s: s.isNotNull())
    )
    # one name per entity (the later of two names wins); very short names match too much
    by_entity = {entity: name.lower() for name, entity in names.items() if len(name) > 3}
    if title is not None and by_entity:
        whole = F.coalesce(F.col(body), F.lit("")) if body else F.lit("")
        whole = F.substring(whole, 1, scan_chars) if scan_chars else whole
        text = F.lower(F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), whole))
        triggers, table = name_table(by_entity)
        # "" stands for names without a word, which every text may hold
        words = F.array_append(F.split(text, r"(?U)\W+"), F.lit(""))
        near = F.flatten(F.transform(F.array_intersect(words, triggers), lambda w: F.element_at(table, w)))
        found_names = F.filter(near, lambda n: n["p"].isNull() | F.regexp_like(text, n["p"]))
        found = F.array_union(found, F.transform(F.array_sort(found_names), lambda n: n["e"]))
    if proxy is None:
        return found
    market_wide = F.exists(toks, lambda t: t.isin(market))
    return F.when((F.size(found) == 0) & market_wide, F.array(F.lit(proxy))).otherwise(found)


def source_tier(name, premium: list | None = None, low: list | None = None) -> Column:
    """1 premium, 3 low quality, 2 everything else."""
    name = F.col(name) if isinstance(name, str) else name
    return (
        F.when(name.isin(rules.PREMIUM_SOURCES if premium is None else premium), 1)
        .when(name.isin(rules.LOW_SOURCES if low is None else low), 3)
        .otherwise(2)
    )


def tier_weight(tier, weights: dict | None = None) -> Column:
    """Weight of a source tier; unknown or null tiers weigh 1."""
    weights = rules.TIER_WEIGHTS if weights is None else weights
    return F.coalesce(F.element_at(lookup(weights), F.col(tier).cast("int")), F.lit(1.0))


def classify_event(categories, title, category_events: dict | None = None, title_events: list | None = None) -> Column:
    """Event class: first category token that has a rule, else first matching title pattern, else OTHER."""
    table = lookup(rules.CATEGORY_EVENTS if category_events is None else category_events)
    patterns = rules.TITLE_EVENTS if title_events is None else title_events
    by_category = F.try_element_at(
        F.filter(F.transform(label_tokens(categories), lambda t: F.element_at(table, t)), lambda e: e.isNotNull()),
        F.lit(1),
    )
    by_title = reduce(
        lambda acc, rule: acc.when(F.col(title).rlike(whole_word(rule[1])), rule[0]), patterns, F
    )
    return F.coalesce(by_category, by_title, F.lit(rules.OTHER_EVENT))


def polarity_score(pos, neg, neutral) -> Column:
    """struct(score = pos - neg, confidence = largest class probability), 6 dp."""
    pos, neg, neutral = (F.coalesce(F.col(c), F.lit(0.0)) for c in (pos, neg, neutral))
    return F.struct(
        F.round(pos - neg, 6).alias("score"), F.round(F.greatest(pos, neg, neutral), 6).alias("confidence")
    )


def composite_score(title_score, body_score) -> Column:
    return F.round(0.4 * title_score + 0.6 * body_score, 6)


def model_text(text, placeholder: str = rules.BLANK_TEXT) -> Column:
    """Text as handed to a scoring model: whole, blanks replaced (see :func:`text_pieces`)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.when(F.length(F.regexp_replace(whole, r"(?U)\s", "")) == 0, F.lit(placeholder)).otherwise(whole)


def text_pieces(text, chars: int = rules.MODEL_TEXT_CHARS) -> Column:
    """Consecutive pieces of at most ``chars`` characters that together are the whole text."""
    text = F.col(text) if isinstance(text, str) else text
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(chars))
    return F.transform(starts, lambda at: F.substring(text, at, F.lit(chars)))


def url_id(url) -> Column:
    """Signed 64-bit id: first 8 bytes of SHA-1(url), big endian."""
    return F.conv(F.substring(F.sha1(F.col(url)), 1, 16), 16, -10).cast("bigint")


def event_group(event_type, groups: dict | None = None) -> Column:
    return F.element_at(lookup(rules.EVENT_GROUPS if groups is None else groups),
                        F.coalesce(F.col(event_type), F.lit(rules.OTHER_EVENT)))


def event_magnitude(group, magnitudes: dict | None = None) -> Column:
    table = lookup(rules.EVENT_MAGNITUDES if magnitudes is None else magnitudes)
    return F.coalesce(F.element_at(table, F.col(group)), F.lit(0.0))


def word_count(*cols) -> Column:
    """Whitespace-separated words over all given columns; null counts as empty."""
    def one(c):
        trimmed = F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", " "))
        return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " ")))
    return reduce(lambda a, b: a + b, [one(c) for c in cols])


def contains_any(col: Column, words: list) -> Column:
    return reduce(lambda a, b: a | b, [col.contains(w) for w in words])


def matching_classes(col: Column, classes: list, default: str = "other") -> Column:
    """All class names whose keywords occur in ``col``; ``[default]`` when none does."""
    hits = F.filter(
        F.array(*[F.when(contains_any(col, words), F.lit(name)) for name, words in classes]),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(hits) == 0, F.array(F.lit(default))).otherwise(hits)


def first_class(col: Column, classes: list) -> Column:
    """First class whose keywords occur in ``col``, null when none does."""
    return reduce(lambda acc, c: acc.when(contains_any(col, c[1]), c[0]), classes, F)
