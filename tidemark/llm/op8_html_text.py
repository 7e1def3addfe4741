"""Main text of web pages from flat text blocks.

A page becomes a flat list of text blocks.  Each block has its word count, link
density and sentence marks, the same of the blocks before and after it, and as
one input among these what its containers say (inside the page's article; on a
page that marks none; outside of the one it marks; inside a container that names
itself navigation, advert, comments ...).  A decision tree, grown on a small table
of blocks labelled by hand, says which blocks are main text.

An element whose content is no text (a button, a drawing) is passed over up to
its end tag; one that is never closed, up to the next block only.

Defined results: a null or empty html, or one without main text, gives the
empty text; repeated rows are extracted row by row; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import table

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead title tr ul".split())
_CONTAINER = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form head header html main menu nav "
    "ol search section span table td ul tr tbody thead tfoot li".split())
#: Elements whose content is never text of the page.
_SKIP = frozenset(
    "script style noscript template svg iframe object video audio canvas select textarea button title datalist "
    "map annotation".split())
_BOILER_TAG = frozenset("nav aside footer form header dialog menu search".split())
_BOILER_ROLE = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words of class and id names that say what a container holds.
_BOILER_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright discussion disqus footer form gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification pagination pager popup promo promoted promotion recommended related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags toc toolbar topbar widget".split())
_MAIN_NAME = frozenset("article post entry story content main text articlebody".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SENTENCE = re.compile(r"[.!?\u2026\u3002](?=\s|$)")


class _Blocks(HTMLParser):
    """Flat blocks: [text, words, linked words, boiler, scope, heading, sentence marks]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.stack: list[tuple] = [("", False, False, 0)]  # tag, hard boiler, soft boiler, scope
        self.skip: list[str] = []
        self.open_skip = ""  # an element without an end tag, passed over up to the next block
        self.ends: dict[str, int] = {}  # end tags that are still to come
        self.parts: list[str] = []
        self.words = self.linked = self.link = 0
        self.heading = False

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                n = text.count(" ") + 1
                _, hard, soft, scope = self.stack[-1]
                self.blocks.append([text, n, min(self.linked, n), hard or soft, scope, self.heading, len(_SENTENCE.findall(text))])
            self.parts = []
        self.linked = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("body", "article", "p", "div"):
            self.skip = [t for t in self.skip if t != "title"]
        if tag in _SKIP:
            if self.ends.get(tag, 0) > self.skip.count(tag):
                self.skip.append(tag)
            elif not self.skip:
                self.open_skip = tag
            return
        if self.skip:
            return
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.link = 1
        if tag in _BLOCK:
            self.flush()
            self.link = 0
            self.heading = tag in _HEADING
            if not (self.open_skip == "select" and tag in ("option", "optgroup")):
                self.open_skip = ""
        if tag in _CONTAINER:
            if tag == "body":
                del self.stack[1:]
            elif tag in ("li", "td", "tr") and self.stack[-1][0] == tag:
                self.stack.pop()
            self.stack.append(self.entered(tag, attrs))

    def entered(self, tag: str, attrs: list) -> tuple:
        _, hard, soft, scope = self.stack[-1]
        names: set[str] = set()
        role = ""
        for key, value in attrs:
            if key in ("class", "id", "itemprop"):
                names.update(x.lower() for x in _NAME.findall(value or ""))
                names.update((value or "").lower().split())
            elif key == "role":
                role = (value or "").lower()
        own = tag not in ("body", "html") and bool(names & _BOILER_NAME)
        if tag in ("article", "main") or role in ("main", "article"):
            # a wrapper's class name (such as "with-sidebar") doesn't reach into the article
            soft, scope = own, max(scope, 2 if tag == "article" or role == "article" else 1)
        elif names & _MAIN_NAME and not own and tag not in ("body", "html"):
            scope = max(scope, 1)
        if tag in _BOILER_TAG and not (tag == "header" and scope == 2) or role in _BOILER_ROLE:
            hard = True
        return tag, hard, soft or own, scope

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIP:
            self.ends[tag] = self.ends.get(tag, 0) - 1
        if tag in self.skip:
            while self.skip.pop() != tag:
                pass
            return
        if self.skip:
            return
        if tag == "a":
            self.link = 0
        if tag in _BLOCK or tag in _CONTAINER and tag != "span":
            self.flush()
            self.heading = False
        if tag in _CONTAINER:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    break

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag in _BLOCK:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.skip and not self.open_skip:
            self.parts.append(data)
            if self.link:
                self.linked += len(data.split())


_END = re.compile("</(" + "|".join(sorted(_SKIP)) + r")\b", re.I)


def blocks_of(html: str | None) -> list[list]:
    p = _Blocks()
    p.ends = Counter(t.lower() for t in _END.findall(html or ""))
    p.feed(html or "")
    p.close()
    p.flush()
    return p.blocks


ARTICLE, UNMARKED, OUTSIDE, BOILER = range(4)


def contexts(blocks: list[list]) -> list[int]:
    """What each block's containers say."""
    best = max((b[4] for b in blocks if not b[3]), default=0)
    return [BOILER if b[3] else UNMARKED if not best else ARTICLE if b[4] == best else OUTSIDE for b in blocks]


FEATURES = ("words", "link density", "sentence marks", "words before", "density before", "marks before",
            "words after", "density after", "marks after", "heading", "context")


def features(blocks: list[list]) -> np.ndarray:
    """One row per block, as :data:`FEATURES` has it; a page's first and last
    block have a neighbour without words."""
    words = np.array([b[1] for b in blocks], float)
    dens = np.array([b[2] for b in blocks], float) / np.maximum(words, 1)
    marks = np.array([b[6] for b in blocks], float)
    own = np.column_stack([words, dens, marks])
    none = np.zeros((1, 3))
    return np.column_stack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]),
                            np.array([b[5] for b in blocks], float), np.array(contexts(blocks), float)])


#: The labelled table: blocks of pages as they stand in order.  + or -: main
#: text or not; a, n, o, b: in the article, on a page that marks none, outside of
#: the one it marks, in a named boilerplate container; #: a heading; [links].
LABELLED = """
-b [Home] [News] [Sport] [Weather]
+a# Ferry service returns to the northern islands
+a By our correspondent
+a After eleven weeks in dry dock the ferry left the harbour on Tuesday morning with forty passengers and two lorries on board. The crew had spent most of that time replacing the stern door, which had jammed in January.
+a "It is good to be moving again," said the captain.
+a The company expects three crossings a day until the end of [September], weather permitting.
-a [Share] [Tweet] [Email]
-a [More ferry news] [Island timetable]
-b Comments
-b I took the first crossing and the coffee was cold, but the view was as good as ever. Well done to the crew.
-b Copyright 2021 Northern Gazette. All rights reserved.

-o [Skip to content]
-o Subscribe now and read every story for one pound a week.
+a# Bread without kneading
+a Mix the flour, the salt and the yeast in a large bowl. Add the water and stir until no dry flour is left.
+a# You need
+a 400 g flour
+a 8 g salt
+a 1 g yeast
+a 300 ml water
+a# Method
+a Cover the bowl and leave it for eighteen hours at room temperature. The dough should be bubbly and loose.
+a Bake in a hot pot for half an hour with the lid on, then a quarter of an hour without it.
-o [Ten soups for cold days] [Our best cakes]
-o Like this recipe? Our weekly letter brings you three new ones every Friday. You can leave at any time.

-n [Start] [Archiv] [Kontakt]
+n# Der alte Bahnhof
+n Der Bahnhof am Rand der Stadt wurde vor hundert Jahren gebaut und steht seit langem leer. Nun soll dort eine Werkstatt entstehen, in der junge Leute alte Waggons wieder herrichten.
+n Die Stadt hat das Dach bereits erneuert. Im Herbst folgen die Fenster.
+n Wer mitarbeiten will, findet die Termine [hier] und kann sich bis zum Sommer melden.
-n [Impressum] [Datenschutz]
-n Wir freuen uns auf Sie

-n [Accueil] [Rubriques]
-n Publicité
+n# Le marché du samedi
+n Chaque samedi, une trentaine de producteurs installent leurs étals sur la place. On y trouve des légumes, du miel et des fromages de chèvre.
+n Ouvert de 8 h à 13 h
+n Le marché est né il y a vingt ans de l'idée de deux voisins qui voulaient vendre leurs pommes sans intermédiaire. Il a grandi depuis, et la mairie lui a donné un toit.
-n [Mentions légales] [Plan du site] [Haut de page]

-n [Inicio] [Tienda] [Carrito]
-n Envío gratis
+n El faro se encendió por primera vez en el invierno de 1874 y guio a los barcos durante más de un siglo. Hoy es un museo pequeño con una sala dedicada a las tormentas.
+n Los domingos se puede subir a la torre. La entrada cuesta dos euros.
-n [Síguenos] [Boletín]
-n Todos los derechos reservados

-n [Docs] [API] [Blog]
+n# Reading a file line by line
+n Opening a file gives an iterator over its lines, so a loop reads one line at a time and a large file never has to fit into memory.
+n for line in open(path): print(line)
+n Each line keeps its line end. Strip it where it is in the way, and close the file when the work is done.
+n# See also
-n [Writing files] [Paths] [Encodings]
-n [Edit this page]

-o Breaking
-o [Markets fall for the third day]
+a# Harvest figures
+a The table shows the harvest of the three largest farms in tonnes, as reported to the county office in October.
+a Farm
+a Wheat
+a Barley
+a Hillside
+a 210
+a 95
+a Lower Mill
+a 180
+a 120
+a Figures for oats were not collected in that year. They will be part of the next report.
-o [Previous] [Next]

-b This site uses cookies to remember you and to count its visitors. By reading on you agree to that.
-b [Accept] [Settings]
+a# A walk along the canal
+a Start at the lock and keep the water on your left. After a mile the path leaves the trees, and the old pumping station comes into view across the fields.
+a [Map of the walk]
+a The second half is shorter and drier. Allow two hours, or three with children.
+a "The best walk in the county." A reader
-b Sign up for our letter. We write once a month and never share your address.
-b [Walks] [Maps] [About us] [Contact]

-n [Forum] [Login] [Register]
-n Posted yesterday
+n My old amplifier hums as soon as I plug in the second speaker, even with nothing else connected. Has anybody seen that before? I have tried two other cables and another socket.
+n The hum goes away when I touch the case.
-n [Reply] [Quote] [Report]
-n Powered by a small server in the cellar

-n Advertisement
-n [Cheap flights from your airport] [Hotels] [Cars]
+n# What the tide leaves behind
+n Twice a day the sea draws back and leaves a strip of sand that belongs to nobody. Crabs cross it, and gulls, and in the morning the people who look for glass.
+n Green glass is common. Blue is rare.
+n Red is rarer still, and most who have searched this beach for a lifetime have found one piece or none at all.
-n [Back to top]
-n Page 3 of 12

-b [Menu]
-o Sponsored: a new kind of mattress that your back will thank you for. Try it for a hundred nights.
+a# Council agrees new budget
+a The council agreed on Monday.
+a It was the shortest sitting in years. Nobody spoke against the plan, and only one member asked for the money for the swimming pool to be counted again.
+a Yes: 31
+a No: 2
-a [Council] [Budget] [Swimming]
-a [Print] [Save]
-b [Read next: who pays for the pool?]
-b Reader views: the pool has been closed for two winters now and nobody at the town hall can say why.

-n [Index] [Search]
-n Last changed in May
+n The word comes from the old name for a shallow boat. It was first written down in a list of tolls that every boat had to pay at the bridge, and the list has come down to us in two copies.
+n# Spelling
+n Both forms are found. The longer one is older.
+n Later scribes kept the short one, perhaps because the space on a toll slip was small and the ink was dear.
-n [Contents] [Next entry]
-n Printed from an online edition

-n [Home] [Archive]
+n# A bridge of rope
+n The bridge is made new every June. Families from both sides of the gorge bring a length of rope that they have twisted from dry grass, and on the third day the two halves meet in the middle.
+n Nobody uses nails.
+n When the new ropes hold, the old ones are cut and fall into the river, and there is dancing until the food is gone.
-n Filed under bridges
-n [Ropes] [Rivers] [Festivals]

-n [Startseite]
+n Die Glocke hing dreihundert Jahre im Turm und wurde in beiden Kriegen versteckt. Als man sie wieder aufhängte, war der Klöppel verschwunden, und ein Schmied aus dem Nachbarort fertigte einen neuen.
+n Sie wiegt vier Tonnen.
+n Zu hören ist sie nur an hohen Feiertagen, weil das Mauerwerk geschont werden soll.
-n Artikel drucken
-n [Nach oben] [Kontakt] [Suche]

-n [Portada] [Opinión]
+n# La biblioteca del puerto
+n La biblioteca abrió en un almacén de sal y todavía huele a mar. Los vecinos trajeron las primeras mesas, y los libros llegaron en cajas de naranjas desde tres pueblos.
+n Abre por las tardes.
+n El préstamo es gratuito para todos, también para quien solo pasa unos días en la costa.
-n Compartir esta página
-n [Correo] [Imprimir]

-n [Une] [Sports] [Culture]
+n Le moulin tourne encore deux fois par an, quand le meunier ouvre les vannes pour les visiteurs. La farine part en petits sacs, et il n'en reste jamais le soir.
+n On peut aussi dormir sur place.
+n Les chambres donnent sur la roue, ce qui plaît aux enfants et moins à ceux qui ont le sommeil léger.
-n Lire aussi
-n [Autre article] [Encore un article]

-n [Home] [Search]
+n# Repairing a cane chair
+n Soak the cane for half an hour, then weave from the back to the front and keep every strand under the same pull. The seat tightens as it dries.
+n Leave it overnight.
+n In the morning trim the ends and press the last strip of cane into the groove with a blunt knife.
-n Was this page useful
-n [Yes] [No]
-n Version of last spring
"""


def labelled_blocks() -> list[tuple[list[list], list[bool], list[int]]]:
    """(blocks, labels, contexts) of each labelled page."""
    scope = {"a": (False, 1), "n": (False, 0), "o": (False, 0), "b": (True, 0)}
    out = []
    for page in LABELLED.strip().split("\n\n"):
        blocks, labels = [], []
        for line in page.split("\n"):
            head, text = line.split(" ", 1)
            boiler, level = scope[head[1]]
            linked = sum(len(x.split()) for x in re.findall(r"\[([^\]]*)\]", text))
            text = text.replace("[", "").replace("]", "")
            blocks.append([text, len(text.split()), linked, boiler, level, head.endswith("#"), len(_SENTENCE.findall(text))])
            labels.append(head[0] == "+")
        out.append((blocks, labels, ["anob".index(line[1]) for line in page.split("\n")]))
    return out


def labelled_table(copies: int = 24, seed: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages, and of ``copies`` of each in
    which blocks are missing and have other lengths, so that no threshold hangs
    on the length of one text."""
    rng = np.random.default_rng(seed)
    rows, out = [], []
    for blocks, labels, _ in labelled_blocks():
        rows.append(features(blocks))
        out += labels
        for _ in range(copies):
            stays = [rng.random() > 0.2 for _ in blocks]
            # a page that marks its article still holds some of it
            stays = [s or b[4] > 0 and not any(t and c[4] > 0 for t, c in zip(stays, blocks)) for s, b in zip(stays, blocks)]
            some = []
            for b in (b for b, s in zip(blocks, stays) if s):
                f = float(np.exp(rng.normal(0, 0.5)))
                n = max(1, round(b[1] * f))
                some.append([b[0], n, round(n * b[2] / b[1]), *b[3:6], max(round(b[6] * f), int(b[6] > 0))])
            rows.append(features(some))
            out += [y for y, s in zip(labels, stays) if s]
    return np.vstack([r for r in rows if len(r)]), np.array(out)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
    """A classification tree by Gini impurity: (feature, threshold, left,
    right), or the label at a leaf.  Ties go to the first feature and the
    smallest threshold, so the tree is the same everywhere."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return bool(share >= 0.5)
    best = (2 * share * (1 - share) * len(y) - 1e-9, None, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= t
            a, b = y[left], y[~left]
            if min(len(a), len(b)) < least:
                continue
            g = sum(2 * s.mean() * (1 - s.mean()) * len(s) for s in (a, b))
            if g < best[0] - 1e-12:
                best = (g, f, t)
    if best[1] is None:
        return bool(share >= 0.5)
    left = x[:, best[1]] <= best[2]
    return best[1], float(best[2]), grow(x[left], y[left], depth - 1, least), grow(x[~left], y[~left], depth - 1, least)


@lru_cache(maxsize=1)
def trained():
    return grow(*labelled_table())


def classify(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, bool):
        return np.full(len(x), tree)
    f, t, a, b = tree
    left = x[:, f] <= t
    out = np.empty(len(x), bool)
    out[left] = classify(a, x[left])
    out[~left] = classify(b, x[~left])
    return out


def main_text(html: str | None, tree=None) -> str:
    blocks = blocks_of(html)
    if not blocks:
        return ""
    good = classify(tree if tree is not None else trained(), features(blocks))
    return "\n\n".join(b[0] for b, g in zip(blocks, good) if g)


def extracted(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` in column ``out``."""
    tree = trained()

    @pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h, tree) for h in htmls], dtype=object)

    return pages.withColumn(out, run.asNondeterministic()(F.col(html_col)))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
