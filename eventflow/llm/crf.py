"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventflow.llm.dom import Block, Node, leaf_blocks

# Word groups of class names, ids and roles.
GROUPS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pager pagination tabs tablist skip",
    "head": "header head masthead top topbar banner logo brand branding site",
    "foot": "footer foot bottom copyright colophon legal contentinfo credits",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular "
            "complementary more tags share social sharing",
    "note": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
            "warning toast dialog privacy paywall",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted "
          "dfp adsense commercial partner",
    "form": "form login signin signup register search searchbox contact input",
    "talk": "comment comments reply replies respond discussion disqus thread responses reviews guestbook reader",
    "text": "content article post entry story main body text prose maintext articlebody articletext page "
            "document paragraph",
    "hide": "hidden",
}
NEAR = frozenset("nav header footer aside form article main section dialog".split())
GROUP_OF = {word: group for group, words in GROUPS.items() for word in words.split()}


class Path(NamedTuple):
    """What the field reads of a block's ancestors."""

    found: frozenset[str] = frozenset()  # tags and word groups, a bounded set
    near: str = ""  # the nearest of the telling tags and groups
    leaf: str = ""
    over: str = ""

    def below(self, entry: str) -> Path:
        tag, *tokens = entry.split(" ")
        groups = [GROUP_OF[t] for t in tokens if t in GROUP_OF]
        near = groups[-1] if groups else tag if tag in NEAR else self.near
        own = {f"tag={tag}", *(f"group={g}" for g in groups)}
        found = self.found if own <= self.found else self.found | own
        return Path(found, near, tag, self.leaf)


def path_of(node: Node | None) -> Path:
    """Made once for each node, from its parent's."""
    waiting = []
    while node is not None and node.state is None:
        waiting.append(node)
        node = node.parent
    path = Path() if node is None else node.state
    for node in reversed(waiting):
        path = node.state = path.below(node.entry)
    return path


def path_features(path: Path) -> list[str]:
    """Ancestor tags and the word groups of their attributes, the nearest ones apart."""
    return sorted({"bias", *path.found, f"near={path.near}", f"leaf={path.leaf}", f"over={path.over}"})


def text_features(block: Block, place: int, count: int) -> list[str]:
    """Length, links, punctuation and place of a block."""
    text = block.text
    words = text.count(" ") + 1
    found = [f"words={min(int(math.log2(words)), 7)}", f"linked={int(block.linked * 4)}"]
    if text[-1] in ".!?:;\"')»“”…":
        found.append("ends")
    if text[0] in "©®" or "©" in text[:40]:
        found.append("copyright")
    if words > 3 and ("," in text or "." in text[:-1]):
        found.append("clauses")
    if place == 0:
        found.append("first")
    if place == count - 1:
        found.append("last")
    return found


@dataclass
class Field:
    """Weights of the content label by feature, and scores of neighbouring labels."""

    weights: dict[str, float]
    steps: list[list[float]]  # steps[a][b]: label a, then b
    paths: dict[Path, float] = field(default_factory=dict)

    def emission(self, block: Block, place: int, count: int) -> float:
        path = path_of(block.node)
        score = self.paths.get(path)
        if score is None:
            if len(self.paths) > 10_000:
                self.paths.clear()
            score = sum(self.weights.get(f, 0.0) for f in path_features(path))
            self.paths[path] = score
        return score + sum(self.weights.get(f, 0.0) for f in text_features(block, place, count))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most likely labels of a page (Viterbi); True is content."""
        if not blocks:
            return []
        (s00, s01), (s10, s11) = self.steps
        e = [self.emission(b, i, len(blocks)) for i, b in enumerate(blocks)]
        a, b, back = 0.0, e[0], []
        for x in e[1:]:
            stay, drop, rise, hold = a + s00, b + s10, a + s01, b + s11
            back.append((drop > stay, hold >= rise))
            a, b = max(stay, drop), max(rise, hold) + x
        label = b > a
        out = [label]
        for from_a, from_b in reversed(back):
            label = from_b if label else from_a
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[Block], list[bool]]], *, epochs: int = 12, seed: int = 5) -> Field:
    """Maximum likelihood with a small ridge, by gradient steps on one page at a time."""
    index: dict[str, int] = {}
    data = []
    for blocks, labels in pages:
        rows = [
            [index.setdefault(f, len(index)) for f in (*path_features(path_of(b.node)), *text_features(b, i, len(blocks)))]
            for i, b in enumerate(blocks)
        ]
        data.append((rows, np.array(labels, int)))
    w, steps = np.zeros(len(index)), np.zeros((2, 2))
    size, rng = np.full(len(index), 1e-2), random.Random(seed)
    steps_size = np.full((2, 2), 1e-2)
    for _ in range(epochs):
        rng.shuffle(data)
        for rows, y in data:
            n = len(rows)
            if not n:
                continue
            e = np.zeros((n, 2))
            e[:, 1] = [w[r].sum() for r in rows]
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = e[0]
            for i in range(1, n):
                ahead[i] = e[i] + np.logaddexp(ahead[i - 1][0] + steps[0], ahead[i - 1][1] + steps[1])
            for i in range(n - 2, -1, -1):
                nxt = e[i + 1] + behind[i + 1]
                behind[i] = np.logaddexp(steps[:, 0] + nxt[0], steps[:, 1] + nxt[1])
            total = np.logaddexp(*ahead[-1])
            p = np.exp(ahead + behind - total)[:, 1]
            grad = np.zeros(len(w))
            for r, d in zip(rows, y - p):
                grad[r] += d
            grad -= 1e-3 * w
            pair = np.zeros((2, 2))
            for i in range(1, n):
                pair -= np.exp(
                    ahead[i - 1][:, None] + steps + (e[i] + behind[i])[None, :] - total
                )
                pair[y[i - 1], y[i]] += 1
            size += grad**2
            steps_size += pair**2
            w += 0.5 * grad / np.sqrt(size)
            steps += 0.5 * (pair - 1e-3 * steps) / np.sqrt(steps_size)
    return Field({f: float(w[i]) for f, i in index.items()}, steps.tolist())


MARK = ""  # private-use character that marks content in labelled pages


def labelled_pages(count: int = 300, seed: int = 3) -> list[tuple[list[Block], list[bool]]]:
    """Pages laid out at random in several styles, every leaf block labelled.

    They vary in elements, class names, nesting, order, missing end tags and in what stands
    in and around the article: menus, headers, footers, sidebars, notices, adverts, forms
    and reader comments. Only markup and lengths teach; the words are random letters.
    """
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(2, 9)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(rng.randint(a, b))).capitalize()

    def prose(a: int, b: int) -> str:
        return " ".join(words(2, 14) + rng.choice("...,?!") for _ in range(rng.randint(a, b)))

    def pick(group: str) -> str:
        return rng.choice(GROUPS[group].split())

    def attr(*groups: str) -> str:
        if rng.random() < 0.25:
            return ""
        name = "-".join(filter(None, [pick(rng.choice(groups)), word() if rng.random() < 0.3 else ""]))
        return f' {rng.choice(["class", "class", "id"])}="{name}"'

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n))

    def menu() -> str:
        tag = rng.choice(["nav", "nav", "div", "ul"])
        items = links(rng.randint(2, 9))
        if tag == "nav":
            return f"<nav{attr('menu')}><ul>{items}</ul></nav>"
        inner = items if tag == "ul" else f"<ul>{items}</ul>"
        return f'<{tag} class="{pick("menu")}">{inner}</{tag}>'

    def advert() -> str:
        tag = rng.choice(["div", "div", "aside", "section"])
        body = rng.choice([prose(1, 3), f"<p>{prose(1, 3)}</p>", f"<a href='/x'>{words(2, 9)}</a>"])
        return f'<{tag} class="{pick("ad")}">{body}</{tag}>'

    def notice() -> str:
        tag = rng.choice(["div", "div", "section", "dialog", "aside"])
        body = f"<p>{prose(1, 3)}</p>" if rng.random() < 0.6 else prose(1, 2)
        return f'<{tag} class="{pick("note")}">{body}<button>{words(1, 2)}</button></{tag}>'

    def side() -> str:
        tag = rng.choice(["aside", "aside", "div"])
        own = f' class="{pick("side")}"' if tag == "div" else attr("side")
        body = f"<h3>{words(1, 3)}</h3><ul>{links(rng.randint(1, 6))}</ul>"
        body += f"<p>{prose(1, 4)}</p>" * (rng.random() < 0.5)
        return f"<{tag}{own}>{body}</{tag}>"

    def form() -> str:
        body = f"<label>{words(1, 3)}</label><input name='q'><p>{prose(1, 2)}</p><button>{words(1, 2)}</button>"
        return f"<form{attr('form')}>{body}</form>"

    def header() -> str:
        own = rng.choice(["<header", "<header", '<div class="{}"'.format(pick("head"))])
        tag = own[1:].split(" ")[0]
        body = rng.choice([f"<h1>{words(1, 4)}</h1>", f"<a href='/'>{words(1, 3)}</a>", f"<p>{words(1, 6)}</p>"])
        body += f"<p>{words(2, 8)}</p>" * (rng.random() < 0.4) + menu() * (rng.random() < 0.4)
        return f"{own}>{body}</{tag}>"

    def footer() -> str:
        own = rng.choice(["<footer", "<footer", '<div class="{}"'.format(pick("foot"))])
        tag = own[1:].split(" ")[0]
        body = rng.choice([f"&copy; {word()}.com &middot; {prose(1, 3)}", f"<p>{prose(1, 3)}</p>", f"<ul>{links(3)}</ul>"])
        return f"{own}>{body}</{tag}>"

    def comments() -> str:
        tag = rng.choice(["div", "section", "section", "ol", "aside"])
        one = rng.choice(["<div class='{}'><p>{}</p></div>", "<p class='{}'>{}</p>", "<article class='{}'><p>{}</p></article>"])
        if tag == "ol":
            one = "<li class='{}'><p>{}</p></li>"
        body = "".join(one.format(pick("talk"), prose(1, 6)) for _ in range(rng.randint(1, 6)))
        title = f"<h2>{words(1, 3)}</h2>" * (tag != "ol" and rng.random() < 0.6)
        return f'<{tag} class="{pick("talk")}">{title}{body}</{tag}>'

    def content(title: bool, inside: list[str]) -> str:
        close = "" if rng.random() < 0.15 else "</p>"
        parts = []
        if title:
            head = f"<h1>{MARK}{words(3, 12)}</h1>"
            parts.append(f"<header>{head}</header>" if rng.random() < 0.15 else head)
        for i in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.72:
                bold = "<b>" if i == 0 and rng.random() < 0.4 else ""
                parts.append(f"<p>{bold}{MARK}{prose(1, 8)}{'<br>' * (rng.random() < 0.2)}{close}")
            elif kind < 0.80:
                parts.append(f"<h{(n := rng.randint(2, 3))}>{MARK}{words(1, 6)}</h{n}>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{MARK}{words(2, 12)}</li>" for _ in range(rng.randint(2, 4))) + "</ul>")
            elif kind < 0.91:
                parts.append(f"<blockquote><p>{MARK}{prose(1, 3)}</p></blockquote>")
            elif kind < 0.95:
                rows = "".join(f"<tr><td>{MARK}{word()}</td><td>{MARK}{words(1, 3)}</td></tr>" for _ in range(rng.randint(1, 3)))
                parts.append(f"<table>{rows}</table>")
            else:
                parts.append(f"<p>{MARK}<a href='/x'>{word()}</a> {prose(1, 4)}</p>")
            if inside and rng.random() < 0.3:
                parts.append(inside.pop()())
        while inside:
            parts.append(inside.pop()())
        return "".join(parts)

    out = []
    for _ in range(count):
        inside = [rng.choice([advert, notice, side, form, comments, menu]) for _ in range(rng.choice([0, 0, 0, 1, 2]))]
        text = content(rng.random() < 0.8, inside)
        shell = rng.random()
        if shell < 0.6:
            text = f"<article{attr('text') if rng.random() < 0.4 else ''}>{text}</article>"
        elif shell < 0.9:
            text = f'<div class="{pick("text")}">{text}</div>'
        if rng.random() < 0.25:
            text = f"<main>{text}</main>"
        before = [f() for f in (header, menu, notice, advert, form, side) if rng.random() < 0.4]
        after = [f() for f in (side, comments, advert, form, menu, footer, notice) if rng.random() < 0.4]
        rng.shuffle(before)
        page = "".join([*before, text, *after])
        if rng.random() < 0.2:
            page = f'<div id="{rng.choice(["page", "wrapper", "container", "site"])}">{page}</div>'
        blocks, labels = [], []
        for b in leaf_blocks(f"<html><body>{page}</body></html>"):
            labels.append(MARK in b.text)
            plain = " ".join(b.text.replace(MARK, "").split())
            blocks.append(b._replace(text=plain or "-"))
        out.append((blocks, labels))
    return out


@cache
def trained(pages: int = 300, seed: int = 3) -> Field:
    """The field fitted on ``pages`` labelled pages, once in a process."""
    return fit(labelled_pages(pages, seed))


def main_text(page: str | None, model: Field) -> str:
    """Content blocks of a page, one a line."""
    blocks = leaf_blocks(page or "")
    return "\n".join(b.text for b, good in zip(blocks, model.decode(blocks)) if good)


def extract(pages: DataFrame, model: Field, html: str = "html") -> DataFrame:
    """Add ``main_text`` to each row: its content blocks joined by line ends.

    Whole pages are read; nothing is dropped or capped but what is labelled as not content.
    A null or empty page, and one without a content block, has an empty text; equal rows
    get equal results; a column named main_text is replaced. An empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.steps))  # fixed features
    kept = pages.drop("main_text")
    schema = T.StructType([*kept.schema.fields, T.StructField("main_text", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            texts = [main_text(p.as_py(), own) for p in batch.column(html)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "main_text"]
            )

    return kept.mapInArrow(run, schema)
