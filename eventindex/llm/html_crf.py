"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

Blocks are labelled text or clutter. Features of a block are its own and its ancestors' tags, the
words of their class, id and role, and classes of length, link share, signs and sentence ends, and
signs of reader comments (headings, author lines, times, reply links) in it and in its box. The
chain's two-by-two transitions let neighbours support each other; Viterbi gives the best labels.

Training pages: a bounded sample of pages that mark their main text with one `article` or `main`
element teach the labels (blocks inside it, without clutter elements there, are text). Each page is
also learnt in rewritten forms, in which the sections carry other tags and class words, its text
holds lists, captions, tables and sections without a name, more kinds
of clutter are added around and inside the text (built from the page's own sentences), and markers
are left out at random, so that the field does not lean on one element. Parameters come from
full-batch gradient ascent on the L2-penalised conditional likelihood.

Defined results: null or empty HTML, and a page without text blocks, give an empty text; unclosed
elements end with their nearest closed ancestor; very deep or long pages are handled in one pass;
hidden elements give no text; comments without any mark or sign of their own in the text's element
cannot be told from it; repeated rows each give a row; an empty table gives an empty result, and a table without markers is
labelled by the rewritten forms' built-in sentences only. Extra columns are ignored, whatever their
names.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import rows_of
from eventindex.llm.html_blocks import Block, blocks

SAMPLE = 96             # marked pages that are learnt
FORMS = 6               # rewritten forms of each, more where there are fewer pages than SAMPLE
LONGEST = 60_000        # characters of a page that may be learnt, a parameter of `fit`
BITS = 13
PENALTY, STEPS = 0.05, 60
MAIN = ("article", "main")
CLUTTER = ("nav", "header", "footer", "aside", "form", "menu")

# words by which the rewritten training pages mark their sections
TEXT_NAMES = ["content", "post", "entry content", "story body", "article body", "main content", "text"]
CLUTTER_NAMES = {
    "menu": ["nav menu", "menu", "navbar", "breadcrumb", "nav links", "toc", "pagination"],
    "header": ["header", "site header", "masthead", "banner", "topbar", "logo"],
    "footer": ["footer", "site footer", "copyright", "legal", "bottom"],
    "sidebar": ["sidebar", "widget", "related", "related posts", "recommended", "aside", "tags"],
    "notice": ["cookie notice", "cookie consent", "notice", "alert", "popup", "modal", "gdpr banner"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad slot"],
    "form": ["newsletter form", "subscribe", "search form", "login", "signup"],
    "comments": ["comments", "comment list", "comment", "reply", "disqus thread", "comment body",
                 "kommentare", "kommentar liste", "commentaires", "comentarios", "commenti", "reacties",
                 "responses", "discussion", "diskussion", "leserbriefe", "opiniones", "avis"],
    "share": ["share", "social", "share buttons", "follow"],
}
CLUTTER_TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"],
                "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "p"],
                "ad": ["div", "aside", "section"], "form": ["form", "div"],
                "comments": ["section", "div", "ol"], "share": ["div", "ul"]}
FILLER = "We use a few words here so that a page without sentences can be learnt too."
# signs of reader comments in four languages
HEADS = ("Comments|Reader comments|Responses|Leave a comment|Kommentare|Leserkommentare|Diskussion|"
         "Commentaires|Réactions|Vos réactions|Comentarios|Opiniones|Deja un comentario").split("|")
REPLIES = "Reply|Like|Report|Antworten|Melden|Gefällt mir|Répondre|Signaler|Responder|Me gusta|Denunciar".split("|")
SAYS = "says|wrote|said|schrieb|sagt|schreibt|a écrit|dit|escribió|dice".split("|")
AGES = ("{} hours ago|{} days ago|{} minutes ago|vor {} Stunden|vor {} Tagen|il y a {} heures|il y a {} jours|"
        "hace {} horas|hace {} días").split("|")
NAMES = "Anna|Jonas|Marie|Pablo|guest42|J. Smith|lucia_m|Reader|Max M.|user1987".split("|")
HEAD_LINE = re.compile(rf"\W*\d*\W*(?:{'|'.join(HEADS)})\W*\d*\W*", re.I)
REPLY_LINE = re.compile(rf"\W*(?:(?:{'|'.join(REPLIES)})\W*\d*\W*)+", re.I)
AGE = re.compile("|".join(a.replace("{}", r"\d+") for a in AGES) +
                 r"|\b\d{1,2}[:.]\d\d\b|\b(?:\d{4}-\d\d-\d\d|\d{1,2}[./]\d{1,2}[./]\d{2,4})\b", re.I)
SAID = re.compile(rf"^\S+(?: \S+){{0,2}} (?:{'|'.join(SAYS)})\b.{{0,40}}:|^\S+(?: \S\S*)?: ", re.I)


def signs(text: str) -> list[str]:
    """Signs of reader comments in a block; of times, where the block is short."""
    found = []
    if len(text) <= 80:
        found += [n for n, p in (("head", HEAD_LINE), ("reply", REPLY_LINE)) if p.fullmatch(text)]
        found += ["age"] * bool(AGE.search(text))
    return found + ["said"] * bool(SAID.match(text[:120]))


def features(page: list[Block]) -> list[list[int]]:
    """Hashed features of each block."""
    own_signs = [signs(b.text) for b in page]
    size, signed, headed = Counter(), Counter(), set()
    for b, found in zip(page, own_signs):
        for box in {b.box, b.top} - {0}:
            size[box] += 1
            signed[box] += bool(found)
            if size[box] == 1 and "head" in found:
                headed.add(box)
    out, commented = [], {}
    for k, b in enumerate(page):
        names = []
        for depth, (tag, words) in enumerate(reversed(b.path)):
            names.append(f"t:{tag}")
            if depth < 2:
                names.append(f"t{depth}:{tag}")
            names.extend(f"n:{w}" for w in words.split())
            names.extend(f"p:{w[:6]}" for w in words.split())
        if "head" in own_signs[k]:
            commented[b.box] = k
        tokens = b.text.count(" ") + 1
        names.append(f"len:{min(9, tokens.bit_length())}")
        names.append(f"link:{min(4, 5 * b.linked // max(1, len(b.text)))}")
        names.append(f"end:{b.text[-1] in '.!?:;…'}")
        names.append(f"copy:{'©' in b.text}")
        names.append(f"own:{b.tag}:{min(6, tokens.bit_length())}")
        names.append(f"list:{b.tag}:{min(4, 5 * b.linked // max(1, len(b.text)))}")
        names.append("first" if k == 0 else "last" if k + 1 == len(page) else "mid")
        names.extend(f"sign:{x}" for x in own_signs[k])
        for kind, box in (("box", b.box), ("top", b.top)):
            if size[box]:
                names.append(f"{kind}:{min(3, -(-4 * signed[box] // size[box]))}")
                if box in headed:
                    names.append(f"{kind}:headed")
        if b.box in commented:
            names.append("below a head")
        out.append(sorted({zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names}))
    return out


def marked(page: list[Block]) -> list[int] | None:
    """Labels from the page's own markers; None if it has none."""
    labels = []
    for b in page:
        tags = [t for t, _ in b.path]
        inside = [i for i, t in enumerate(tags) if t in MAIN]
        labels.append(int(bool(inside) and not any(t in CLUTTER for t in tags[inside[0]:])))
    return labels if any(labels) else None


def rewritten(page: list[Block], labels: list[int], rng: random.Random) -> tuple[list[Block], list[int]]:
    """The page in another form: its text under another wrapper, clutter of all kinds around it."""
    text = [b for b, y in zip(page, labels) if y]
    other = [b.text for b, y in zip(page, labels) if not y] or [FILLER]
    sentences = [s.strip() + "." for b in text for s in b.text.split(". ") if s.strip()] or [FILLER]
    body = (("html", ""), ("body", "")) if rng.random() < 0.5 else (
        ("html", ""), ("body", ""), ("div", rng.choice(["page", "wrapper", "container", "site"])))
    wrap = rng.choice(["article", "main", "div", "div", "section", "td"])
    name = "" if wrap in MAIN and rng.random() < 0.6 else rng.choice(TEXT_NAMES)
    inside = (*body, (wrap, name))

    boxes = iter(range(1, 1 << 30))
    own_box = next(boxes) if wrap in ("div", "section") else 0

    def comments(base: tuple, n: int) -> list[Block]:
        """Reader comments, in half of the cases without a name, by their signs only."""
        tag, box, made = rng.choice(CLUTTER_TAGS["comments"]), next(boxes), []
        named = rng.random() < 0.5
        path = (*base, (tag, rng.choice(CLUTTER_NAMES["comments"]) if named else ""))
        signed = not named or rng.random() < 0.5
        headed = signed and rng.random() < 0.7

        def add(text: str, inner: str, linked: int = 0) -> None:
            made.append(Block(text, (*path, (inner, "")), linked, inner, box, own_box or box))

        if headed:
            add(rng.choice(HEADS) + rng.choice(["", " (3)", ":"]), rng.choice(["h2", "h3", "h4", "p"]))
        style = rng.choice(["line", "said", "plain"] if headed or not signed else ["line", "said"])
        for _ in range(n):
            t, inner = rng.choice(sentences), rng.choice(["p", "div", "li"])
            who = rng.choice(NAMES)
            if signed and style == "line":
                when = rng.choice([*AGES, "12.05.2018 {}:30", "2018-05-{} 10:12"]).format(rng.randint(10, 23))
                add(f"{who} {when}", rng.choice(["p", "div", "h4"]))
            elif signed and style == "said":
                t = f"{who}{rng.choice(['', *(' ' + x for x in SAYS)])}: {t}"
            add(t, inner)
            if signed and rng.random() < 0.4:
                reply = rng.choice(REPLIES)
                add(reply, rng.choice(["p", "div"]), len(reply) * (rng.random() < 0.7))
        return made

    def clutter(kind: str, base: tuple, n: int) -> list[Block]:
        if kind == "comments":
            return comments(base, n)
        box = next(boxes)
        top = box if base is body else own_box or box
        tag = rng.choice(CLUTTER_TAGS[kind])
        names = "" if tag in CLUTTER and rng.random() < 0.5 else rng.choice(CLUTTER_NAMES[kind])
        made = []
        for _ in range(n):
            links = kind in ("menu", "share", "sidebar") and rng.random() < 0.85
            long = kind in ("notice", "ad", "comments", "footer", "form", "sidebar") and not links
            t = rng.choice(sentences if long else other)
            t = t if long else " ".join(t.split()[:rng.randint(1, 4)]) or "x"
            inner = "li" if tag in ("ul", "ol") or kind == "menu" else rng.choice(["p", "div", ""])
            path = (*base, (tag, names), *(((inner, ""),) if inner else ()))
            made.append(Block(t, path, len(t) if links else 0, path[-1][0], box, top))
        return made

    def insert() -> list[Block]:
        """A list, caption or table of the text, of short items or sentences."""
        outer, inner = rng.choice([("ul", "li"), ("ul", "li"), ("ol", "li"), ("figure", "figcaption"),
                                   ("figure", "figcaption"), ("table", "td"), ("dl", "dd")])
        box, short = next(boxes) if outer != "figure" else own_box, rng.random() < 0.5
        made = []
        for _ in range(1 if outer == "figure" else rng.randint(2, 6)):
            t = rng.choice(sentences)
            t = " ".join(t.split()[:rng.randint(1, 5)]) if short else t
            linked = len(t) // 3 if rng.random() < 0.1 else 0
            made.append(Block(t, (*inside, (outer, ""), (inner, "")), linked, inner, box, own_box or box))
        return made

    def title(part: str, box: int) -> Block:
        """The heading of a section of the text."""
        tag = rng.choice(["h2", "h2", "h3", "h4"])
        t = " ".join(rng.choice(sentences).split()[:rng.randint(1, 5)])
        return Block(t, (*inside, (part, ""), (tag, "")), 0, tag, box, own_box or box)

    out: list[tuple[Block, int]] = []
    left, part, box = 0, "", 0

    def put(kinds: list[str], base: tuple) -> None:
        for kind in kinds:
            out.extend((b, 0) for b in clutter(kind, base, rng.randint(1, 5)))

    kinds = list(CLUTTER_NAMES)
    put(rng.sample(["menu", "header", "notice", "ad", "form", "share"], rng.randint(1, 4)), body)
    for k, b in enumerate(text):
        if k and rng.random() < 0.06:
            put([rng.choice(["ad", "share", "sidebar", "form", "notice"])],
                inside if rng.random() < 0.5 else body)
        own = ("h1" if k == 0 and rng.random() < 0.6 else rng.choice(["h2", "h3"])
               if len(b.text) < 60 and rng.random() < 0.3
               else rng.choice(["p", "p", "p", "p", "li", "blockquote", "td", "div", "pre"]))
        if k and not left and rng.random() < 0.2:
            left, part, box = rng.randint(1, 4), rng.choice(["section", "section", "div"]), next(boxes)
            if rng.random() < 0.6:
                out.append((title(part, box), 1))
        if left:                            # a section of the text without a name
            left -= 1
            out.append((Block(b.text, (*inside, (part, ""), (own, "")), b.linked, own, box, own_box or box), 1))
        else:
            out.append((Block(b.text, (*inside, (own, "")), b.linked, own, own_box, own_box), 1))
        if rng.random() < 0.25:
            out.extend((x, 1) for x in insert())
    if rng.random() < 0.3:
        out.extend((x, 1) for x in insert())
    if rng.random() < 0.3:
        part, box = rng.choice(["section", "section", "div"]), next(boxes)
        out.extend((title(part, box), 1) for _ in range(rng.randint(0, 1)))
        out.extend((Block(rng.choice(sentences), (*inside, (part, ""), ("p", "")), 0, "p", box, own_box or box), 1)
                   for _ in range(rng.randint(1, 3)))
    if rng.random() < 0.6:
        put(["comments"], inside if rng.random() < 0.6 else body)
    put(rng.sample(kinds, rng.randint(1, 4)), body)
    if rng.random() < 0.8:
        put(["footer"], body)
    return [b for b, _ in out], [y for _, y in out]


class Field:
    """Weights: feature x label, transition label x label, start x label."""

    def __init__(self, w: np.ndarray, t: np.ndarray, s: np.ndarray):
        self.w, self.t, self.s = w, t, s

    def scores(self, page: list[Block]) -> np.ndarray:
        return np.array([self.w[f].sum(0) for f in features(page)]).reshape(-1, 2)

    def decode(self, page: list[Block]) -> list[int]:
        """Viterbi; ties go to text."""
        if not page:
            return []
        x = self.scores(page).tolist()
        (t00, t01), (t10, t11) = self.t.tolist()
        a, b = self.s[0] + x[0][0], self.s[1] + x[0][1]
        back = []
        for c, d in x[1:]:
            from_a, from_b = (a + t00, b + t10), (a + t01, b + t11)
            back.append((int(from_a[1] >= from_a[0]), int(from_b[1] >= from_b[0])))
            a, b = max(from_a) + c, max(from_b) + d
        label = int(b >= a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit_field(pages: list[tuple[list[list[int]], list[int]]]) -> Field:
    """Maximise the penalised conditional likelihood, all pages side by side."""
    size = 1 << BITS
    w, t, s = np.zeros((size, 2)), np.zeros((2, 2)), np.zeros(2)
    pages = [p for p in pages if p[0]]
    if not pages:
        return Field(w, t, s)
    longest, n = max(len(f) for f, _ in pages), len(pages)
    rows = [(i, k, j) for i, (f, _) in enumerate(pages) for k, fs in enumerate(f) for j in fs]
    at_page, at_block, at_feature = np.array(rows).T
    cell = at_page * longest + at_block
    y = np.full((n, longest), -1)
    for i, (_, labels) in enumerate(pages):
        y[i, :len(labels)] = labels
    real = y >= 0
    speed = [np.zeros_like(p) for p in (w, t, s)]

    def log_sum(x, axis):
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for step in range(STEPS):
        x = np.stack([np.bincount(cell, w[at_feature, c], n * longest) for c in (0, 1)], -1)
        x = x.reshape(n, longest, 2)
        alpha, beta = np.zeros_like(x), np.zeros_like(x)
        alpha[:, 0] = s + x[:, 0]
        for k in range(1, longest):
            moved = log_sum(alpha[:, k - 1, :, None] + t, 1) + x[:, k]
            alpha[:, k] = np.where(real[:, k, None], moved, alpha[:, k - 1])
        for k in range(longest - 2, -1, -1):
            moved = log_sum(t + (x[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
            beta[:, k] = np.where(real[:, k + 1, None], moved, 0)
        z = log_sum(alpha[:, -1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * real[..., None]
        want = np.stack([(y == 0), (y == 1)], -1).astype(float)
        gap = (want - p).reshape(-1, 2)
        g_w = np.stack([np.bincount(at_feature, gap[cell, c], size) for c in (0, 1)], -1)
        both = np.exp(alpha[:, :-1, :, None] + t + (x[:, 1:] + beta[:, 1:])[:, :, None, :]
                      - z[:, None, None, None]) * real[:, 1:, None, None]
        g_t = (want[:, :-1, :, None] * want[:, 1:, None, :]).sum((0, 1)) - both.sum((0, 1))
        g_s = (want[:, 0] - p[:, 0]).sum(0)
        rate = 2.0 / (1 + step / 20)
        for k, (param, g) in enumerate(((w, g_w), (t, g_t), (s, g_s))):
            g = g - PENALTY * param
            speed[k] += g * g
            param += rate * g / (np.sqrt(speed[k]) + 1e-3)
    return Field(w, t, s)


def learn(pages: list[str]) -> Field:
    """Fit on pages that mark their text, and on rewritten forms of them."""
    examples = []
    known = [(page, own, labels) for page in pages
             if (labels := marked(own := blocks(page))) is not None]
    forms = max(FORMS, -(-SAMPLE * FORMS // max(1, len(known))))
    for page, own, labels in known:
        rng = random.Random(zlib.crc32(page.encode("utf-8", "replace")))
        examples.append((features(own), labels))
        for _ in range(forms):
            form, y = rewritten(own, labels, rng)
            examples.append((features(form), y))
    if not examples:    # no page marks its text
        rng, own = random.Random(1), [Block(FILLER * 3, (), 0, "p") for _ in range(6)]
        for _ in range(40):
            form, y = rewritten(own, [1] * len(own), rng)
            examples.append((features(form), y))
    return fit_field(examples)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
        sample: int = SAMPLE, longest: int = LONGEST) -> Field:
    """Learn from at most `sample` marked pages, those of smallest hash. Pages of over `longest`
    characters are not learnt, so what the driver gets is bounded; all pages are decoded whole."""
    text = F.col(html_col).cast("string")
    ids = [r[0] for r in pages.filter((F.length(text) <= longest) & text.rlike("(?i)<(article|main)[ >]"))
           .select(F.col(id_col).alias("i")).filter("i IS NOT NULL").distinct()
           .orderBy(F.xxhash64(F.lit("crf"), "i"), "i").limit(sample).collect()]
    chosen = (pages.filter(F.col(id_col).isin(ids) & (F.length(text) <= longest))
              .select(F.col(id_col).alias("i"), text.alias("h")).orderBy("i", "h").limit(sample).collect())
    return learn([r["h"] for r in chosen])


def main_text(page: str | None, field: Field) -> str:
    own = blocks(page)
    return "\n\n".join(b.text for b, y in zip(own, field.decode(own)) if y)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                texts = [main_text(p, shared.value) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                    ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return (rows.mapInArrow(task, "page_id bigint, url string, text string")
            .withColumn("n_chars", F.length("text").cast("bigint")))
