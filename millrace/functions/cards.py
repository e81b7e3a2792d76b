"""Tariff cards of known kinds of pages, read by rules over the tables of a page.

A rule says which element is a card, which lines its text begins and ends with, and what
the text must hold. Three kinds need more than that (schema.org products, headings with
a price, tariffs with an unspecified period) and have readers of their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from .lines import clean_lines
from .markup import Markup

# Classes, marks and texts of the cards.
CARD_MARKS = r"(?:rates-list-internet__item|card__wrapper|m-tariff__|mkdf-tours-standard-item|catalog-service-card__|class=[\"'][^\"']*dopprice|itemtype=[\"']https?://schema.org/Product|class=[\"'][^\"']*general-cont)"
CARD_SPEED = r"\d+\s*(?:мбит|гбит)"
ANY_SPEED = r"\d+(?:[.,]\d+)?\s*(?:мбит|гбит|mbps|gbps)"
PROMOTION = "Акционный тариф"
ADDABLE = "Можно добавить: "
OPTION_CLASSES = ("m-tariff__options", "additional-services_", "catalog-service-card__linked-products")
CHOICE_CLASS, CHOICE_MARK, CHOSEN_MARK = "universal-regulator__label", ".mm-web-radio__marker", ".mm-web-radio__marker_selected"


def option(page: Markup, i: int) -> bool:
    """Whether an element is an option, no part of the tariff: a list of extras, or a choice that isn't made (speeds always count)."""
    name = page.attrs[i].get("class", "")
    if any(x in name for x in OPTION_CLASSES):
        return True
    if CHOICE_CLASS not in name or not page.select(i, CHOICE_MARK) or re.search(CARD_SPEED, page.text(i), re.I):
        return False
    return not any(page.fits(m, CHOSEN_MARK) for m in page.select(i, CHOICE_MARK))


@dataclass(frozen=True)
class Line:
    """Lines of a card from its elements that fit ``rule``."""

    rule: str
    within: str = ""  # the first element that fits it instead of the card; "^": the element around the card
    every: bool = False  # all of them, not the first only
    needed: bool = False
    like: str = ""  # an element's text (a needed line's) must match
    before: str = ""  # a line before them
    label: str = ""
    joined: bool = False
    last: bool = False  # after the card's text


@dataclass(frozen=True)
class Rule:
    card: str
    lines: tuple[Line, ...]
    holds: tuple[str, ...]  # patterns that the card's text must match
    head: str = ""
    leaf: bool = False  # a card around another one is none
    options: bool = True  # the text has its options too
    named: bool = False  # the first line must not be empty


# The rules, one for each kind of page.
RULES = (
    Rule(
        ".rates-list-internet__item",
        (
            Line(".rates-list-internet__item-title", needed=True),
            Line(".rates-list-internet__item-price", needed=True, like=r"₽\s*/\s*мес"),
            Line(".rates-list-internet__item-proposal", every=True, like="аренда|роутер", label=ADDABLE, last=True),
        ),
        (CARD_SPEED,),
        head="[DOM CARD TITLE]",
    ),
    Rule(
        ".card__wrapper",
        (Line(".card-title", needed=True), Line(".price-sale", before=PROMOTION), Line(".price-main", needed=True, like=r"\d[\d\s]*\s*₽\s*/\s*мес")),
        (CARD_SPEED,),
        head="[DOM CARD TITLE]",
        leaf=True,
        options=False,
        named=True,
    ),
    Rule(
        ".catalog-service-card",
        (
            Line(".catalog-service-card__name", needed=True),
            Line(".catalog-price__original", within=".catalog-service-card__footer", before=PROMOTION),
            Line(".catalog-price__value", within=".catalog-service-card__footer"),
            Line(".catalog-carousel-badge__title", within="^", every=True),
            Line(".catalog-service-card__linked-product", every=True, joined=True, label=ADDABLE),
        ),
        (CARD_SPEED,),
        options=False,
    ),
    Rule(".general-cont /Offer", (Line(".name-title", needed=True),), (CARD_SPEED, r"\d+\s*руб\./(?:мес|год)")),
    Rule(".mkdf-tours-standard-item", (Line(".mkdf-tour-title", needed=True),), (ANY_SPEED,)),
)


def by_rule(page: Markup, card: int, rule: Rule) -> str | None:
    if rule.leaf and page.select(card, rule.card, itself=False):
        return None
    first: list[str] = [rule.head] if rule.head else []
    last: list[str] = []
    for spec in rule.lines:
        scope = card
        if spec.within == "^":
            scope = page.up[card]
        elif spec.within:
            scope = next(iter(page.select(card, spec.within)), None)
            if scope is None:
                return None
        found = page.select(scope, spec.rule)[: None if spec.every else 1]
        texts = [page.line(i) for i in found]
        if spec.needed and not (texts and re.search(spec.like, texts[0], re.I)):
            return None
        texts = [x for x in texts if re.search(spec.like, x, re.I)]
        if rule.named and spec is rule.lines[0] and not texts[0]:
            return None
        if texts:
            texts = [", ".join(texts)] if spec.joined else texts
            (last if spec.last else first).extend([*([spec.before] if spec.before else []), *(spec.label + x for x in texts)])
    body = "\n".join(clean_lines(page.text(card, None if rule.options else option)))
    if not all(re.search(p, body, re.I) for p in rule.holds):
        return None
    if rule.card == ".mkdf-tours-standard-item":
        first += _tour_prices(page, card)
    return "\n".join([*first, body, *last])


def _tour_prices(page: Markup, card: int) -> list[str]:
    """The struck-through and the current price, after a mark of the promotion."""
    style = lambda i, x: x in page.attrs[i].get("style", "")
    name = lambda i, x: x in page.attrs[i].get("class", "")
    struck = {i for i in page.select(card, "") if style(i, "line-through")}
    prices = page.select(card, ".mkdf-tours-item-price")
    old = [i for i in prices if i in struck][:1]
    now = [i for i in prices if i not in struck and not name(i, "discount-price")][:1]
    promoted = struck or any(name(i, "price-with-discount") for i in page.select(card, ""))
    return [*([PROMOTION] if promoted else []), *(page.line(i) for i in (old + now if old and now else []))]


def product(page: Markup, card: int) -> str | None:
    """A schema.org product without another one inside: its properties, then the card that is shown."""
    if page.select(card, "/Product", itself=False):
        return None
    said = lambda of: [(page.attrs[i].get("itemprop"), page.attrs[i].get("content")) for i in page.select(of, "") if page.tag[i] == "meta"]
    own = {}
    for k, v in said(card):
        own.setdefault(k, v)
    pairs = [dict(said(i)) for i in page.select(card, "@itemprop=additionalProperty")]
    more = {p.get("name"): p.get("value") for p in pairs}
    shown = page.select(card, "*rate-card_card")
    if not (own.get("name") and own.get("price") and more.get("internetSpeed") and shown):
        return None
    body = "\n".join(clean_lines(page.text(shown[0], option)))
    if not re.search("мес", body, re.I):
        return None
    out = [own["name"], f"{more['internetSpeed']} Мбит/с"]
    if more.get("tvChannelCount"):
        out.append(f"{more['tvChannelCount']} ТВ-каналов")
    if more.get("mobileIncluded"):  # the schema's 10,000 stands for no limit
        out.append(re.sub(r"\b10000\s+Гб\b", "Безлимитный мобильный интернет", more["mobileIncluded"], flags=re.I))
    extras = [x for x in dict.fromkeys(page.line(i) for i in page.select(shown[0], "*additional-services_wrapperService")) if x]
    if extras:
        out.append(ADDABLE + ", ".join(extras))
    return "\n".join([*out, body])


def is_heading(page: Markup, i: int) -> bool:
    return page.fits(i, ".nametp") or page.fits(i, ".szha .head-black")


def headed(page: Markup, card: int, headings: list[int], prices: list[int]) -> str | None:
    """A heading and its price: the only one up to the next heading (9,000 characters at most), else the only one of the nearest element around it that has no other heading."""
    begin = page.span[card][0]
    stop = min([page.span[h][0] for h in headings if page.span[h][0] > begin][:1] + [begin + 9000])
    found = [p for p in prices if begin < page.span[p][0] < stop]
    around, steps = page.up[card], 0
    while len(found) != 1 and steps < 12:
        within = range(len(page.tag)) if around < 0 else range(around, page.inner[around])
        if sum(h in within for h in headings) > 1:
            return None
        found = [p for p in prices if p in within]
        if around < 0:
            break
        around, steps = page.up[around], steps + 1
    if len(found) != 1:
        return None
    price = re.sub(r"руб\.\s*_+\s*мес\.", "руб./мес", page.line(found[0]), flags=re.I)
    return f"{page.line(card)}\n{price}" if re.search(r"\d+\s*руб\./мес", price, re.I) else None


def unspecified(page: Markup, card: int) -> str | None:
    """A tariff whose price stands in an attribute; where no text says that it is monthly, its source is kept."""
    got = {x: page.select(card, f".m-tariff__{x}")[:1] for x in ("name", "price-value", "speed", "description")}
    if not (got["name"] and got["price-value"] and got["speed"]):
        return None
    price = got["price-value"][0]
    value = page.attrs[price].get("data-cost", "")
    if not re.fullmatch(r"\d+(?:[.,]\d+)?", value):
        return None
    body = "\n".join(clean_lines(page.text(got["description"][0]))) if got["description"] else ""
    extras = dict.fromkeys(page.line(i) for i in page.select(card, "") if page.tag[i] == "label" and page.attrs[i].get("for", "").startswith("tariff_option_"))
    if extras:
        body += "\n" + ADDABLE + ", ".join(extras)
    out = f"{page.line(got['name'][0])}\n{page.line(got['speed'][0])}\n{body}"
    if re.search(r"рублей\s+в\s+месяц", body, re.I):
        return out
    a, b = page.span[price]
    return f"{out}\n[UNSPECIFIED BILLING]\nЦена тарифа: {value} ₽\n[SOURCE PRICE] {page.source[a:b]}"


def dom_cards(markup: str | Markup) -> list[str]:
    """The texts of all cards of a page, each once, in document order."""
    page = markup if isinstance(markup, Markup) else Markup(markup)
    headings = [i for i in range(len(page.tag)) if is_heading(page, i)]
    prices = page.select(-1, ".prc")
    out = []
    # An element that fits several kinds is read as the first of them.
    for i in range(len(page.tag)):
        rule = next((r for r in RULES[:4] if page.fits(i, r.card)), None)
        if rule:
            out.append(by_rule(page, i, rule))
        elif page.fits(i, "/Product"):
            out.append(product(page, i))
        elif page.fits(i, RULES[4].card):
            out.append(by_rule(page, i, RULES[4]))
        elif is_heading(page, i):
            out.append(headed(page, i, headings, prices))
        elif page.fits(i, ".m-tariff"):
            out.append(unspecified(page, i))
    return list(dict.fromkeys(x for x in out if x))
