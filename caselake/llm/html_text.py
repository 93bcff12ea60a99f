"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks. A block is described by hashed elements of
its tag path (tag, class and id words), all of its words, hashed, and a few figures. A bidirectional
LSTM in numpy reads the sequence both ways, so every block is judged with the whole
page around it, and labels it as main text or not.

The model is trained when asked for, on ``sample_pages`` pages chosen by hash, the only
sample. Their labels come from the markup's meaning (inside article or main, not in a
menu, form or the like); each page is also varied: kinds of boilerplate and of content
containers that the sample may lack are put in, filled with words of the sample, so
that structure decides where it tells. Where it does not, wording does: notices, adverts,
sign-up lines and comments, and plain sentences, stand in the same untelling tags.

Defined results: null or empty html, or a page without main text, gives an empty text;
null ids and urls stay null; repeated rows are extracted repeatedly; an empty table
gives an empty result. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements without text of their own, elements inside a line, elements
# that never have an end, and those whose start ends one of the same kind.
SILENT = "script|style|noscript|template|svg|iframe|title|textarea|select|object|canvas|math"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT})\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I)
TAG_START = re.compile(r"</?[a-z]", re.I)
OTHER_MARK = re.compile(r"</[^>]*>")
QUOTED = re.compile(r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_WORD = re.compile(r"[a-z]+")

PATH_DIMS, WORD_DIMS, FIGURES = 128, 512, 8
DIMS = PATH_DIMS + WORD_DIMS + FIGURES


@dataclass(frozen=True)
class Block:
    path: tuple[str, ...]
    text: str
    links: int = 0


def tokens(page: str) -> Iterator[tuple[str | None, str | None, bool, str]]:
    """(text, tag, whether it closes, rest of the tag) of every piece of mark-up or text.

    That a tag has no end shows only in a look at the whole rest of the page. What that
    look found is kept: a later start outside its quoted parts has no end either, so at
    most three such looks are taken (no quote open, or one of two kinds).
    """
    at, failed, last = 0, [], page.rfind(">")
    while at < len(page):
        begins = TAG_START.match(page, at) is not None
        endless = page[at] == "<" and at > last and not page.startswith("<!--", at)
        if endless or begins and any(bisect_right(edges, at) % 2 == 0 for edges in failed):
            other = None if endless else OTHER_MARK.match(page, at)
            if other is None:
                yield "<", None, False, ""
            at = other.end() if other else at + 1
            continue
        token = TOKEN.match(page, at)
        if begins and token["tag"] is None and token["silent"] is None:
            failed.append([edge for part in QUOTED.finditer(page, at) for edge in part.span()])
        yield token["text"], token["tag"], bool(token["close"]), token["rest"] or ""
        at = token.end()


def _path_words(tag: str, rest: str) -> str:
    """An element as its tag and the words of its class, id and role."""
    found = " ".join(a or b or c for a, b, c in NAMED.findall(rest)) if rest else ""
    return " ".join([tag, *[f".{w}" for w in NAME_WORD.findall(found.lower())]])


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: runs of text not parted by a block element."""
    stack: list[tuple[str, str]] = []
    out: list[Block] = []
    parts: list[str] = []
    links, in_link = 0, False

    def flush() -> None:
        nonlocal parts, links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(tuple(words for _, words in stack), text, links))
            parts = []
        links = 0

    for text, tag, closing, rest in tokens(page):
        if text is not None:
            parts.append(text)
            if in_link:
                links += len(text.strip())
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = not closing
            continue
        flush()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        closes = SELF_CLOSING.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        if closes and stack and stack[-1][0] in closes:
            stack.pop()
        if tag not in VOID and not rest.endswith("/"):
            stack.append((tag, _path_words(tag, rest)))
    flush()
    return [b for b in out if "head" not in (p.split(" ")[0] for p in b.path)]


EDGES = "!\"'(),-.:;?[]{}¿¡«»„“”‘’…–—"


def _slot(word: str, dims: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8"))
    return h % dims, 1.0 if h >> 31 else -1.0


class Features:
    """Vectors of blocks; paths repeat, so their part is kept."""

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, tuple[int, float]] = {}

    def text(self, words: Sequence[str]) -> np.ndarray:
        """Sum over all words, by the root of their number."""
        known = self.words
        if len(known) > 200_000:
            known.clear()
        out = np.zeros(WORD_DIMS, np.float32)
        for word in words:
            hit = known.get(word)
            if hit is None:
                hit = known[word] = _slot(word.lower().strip(EDGES), WORD_DIMS)
            out[hit[0]] += hit[1]
        return out / np.sqrt(np.float32(len(words)))

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(path)
        if known is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            known = np.zeros(PATH_DIMS, np.float32)
            for depth, element in enumerate(path):
                last = depth == len(path) - 1
                for word in element.split(" "):
                    for name, weight in ((word, 1.0), (f"{word}<", 1.0 if last else 0.0)):
                        at, sign = _slot(name, PATH_DIMS)
                        known[at] += sign * weight
            self.paths[path] = known
        return known

    def __call__(self, page: Sequence[Block]) -> np.ndarray:
        out = np.zeros((len(page), DIMS), np.float32)
        for i, b in enumerate(page):
            words = b.text.split(" ")
            row = out[i]
            row[:PATH_DIMS] = self.path(b.path)
            row[PATH_DIMS:PATH_DIMS + WORD_DIMS] = self.text(words)
            n = len(b.text)
            row[-FIGURES:] = (
                np.log1p(n) / 6, np.log1p(len(words)) / 4, min(1.0, b.links / n), b.text[-1] in ".!?…\"»”",
                i / len(page), (len(page) - i) / len(page), len(b.path) / 8, b.text.count(",") / len(words))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Two LSTMs over a batch of sequences, one per direction, and a logistic output."""

    def __init__(self, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        scale = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.hidden = hidden
        self.weights = {"out": scale(2 * hidden, 1), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.weights |= {f"x{d}": scale(DIMS, 4 * hidden), f"h{d}": scale(hidden, 4 * hidden),
                             f"c{d}": np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)}

    def _run(self, x: np.ndarray, live: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (steps, batch, hidden) of one direction."""
        steps, batch, _ = x.shape
        h = c = np.zeros((batch, self.hidden), np.float32)
        fed = x @ self.weights[f"x{d}"] + self.weights[f"c{d}"]
        out = np.empty((steps, batch, self.hidden), np.float32)
        n = self.hidden
        for t in range(steps):
            z = fed[t] + h @ self.weights[f"h{d}"]
            gates = _sigmoid(z[:, :3 * n])
            new = np.tanh(z[:, 3 * n:])
            m = live[t][:, None]
            c_new = gates[:, n:2 * n] * c + gates[:, :n] * new
            squashed = np.tanh(c_new)
            if keep is not None:
                keep.append((gates, new, c, squashed, h, m))
            c = np.where(m, c_new, c)
            h = np.where(m, gates[:, 2 * n:] * squashed, h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, sizes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits (steps, batch) of padded sequences (steps, batch, features)."""
        steps = x.shape[0]
        live = np.arange(steps)[:, None] < sizes
        turn = np.where(live, sizes - 1 - np.arange(steps)[:, None], np.arange(steps)[:, None])
        cols = np.arange(x.shape[1])
        logs = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        ahead = self._run(x, live, "f", logs["f"])
        back = self._run(x[turn, cols], live, "b", logs["b"])[turn, cols]
        both = np.concatenate([ahead, back], axis=2)
        if keep is not None:
            keep.update(x=x, live=live, turn=turn, cols=cols, both=both, logs=logs)
        return (both @ self.weights["out"])[:, :, 0] + self.weights["bias"]

    def gradients(self, keep: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of all weights, given those of the logits."""
        n, w = self.hidden, self.weights
        out = {"out": keep["both"].reshape(-1, 2 * n).T @ error.reshape(-1, 1), "bias": error.sum(keepdims=True).reshape(1)}
        states = error[:, :, None] * w["out"][:, 0]
        turn, cols = keep["turn"], keep["cols"]
        for d, part, x in (("f", states[:, :, :n], keep["x"]), ("b", states[turn, cols][:, :, n:], keep["x"][turn, cols])):
            log = keep["logs"][d]
            dz_all = np.zeros((*x.shape[:2], 4 * n), np.float32)
            dh = dc = np.zeros((x.shape[1], n), np.float32)
            gh = np.zeros_like(w[f"h{d}"])
            for t in range(x.shape[0] - 1, -1, -1):
                gates, new, c_old, squashed, h_old, m = log[t]
                total = part[t] + dh
                own, keep_h = np.where(m, total, 0), np.where(m, 0, total)
                i, f, o = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
                dc_new = np.where(m, dc, 0) + own * o * (1 - squashed ** 2)
                dz = np.concatenate([dc_new * new * i * (1 - i), dc_new * c_old * f * (1 - f),
                                     own * squashed * o * (1 - o), dc_new * i * (1 - new ** 2)], axis=1)
                dz_all[t] = dz
                gh += h_old.T @ dz
                dh = dz @ w[f"h{d}"].T + keep_h
                dc = np.where(m, dc_new * f, dc)
            flat = dz_all.reshape(-1, 4 * n)
            out |= {f"x{d}": x.reshape(-1, x.shape[2]).T @ flat, f"h{d}": gh, f"c{d}": flat.sum(axis=0)}
        return out

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, rate: float = 0.01, batch: int = 32) -> None:
        """Adam on the mean cross-entropy of blocks; order fixed by a seed."""
        rng = np.random.default_rng(11)
        one = {k: np.zeros_like(v) for k, v in self.weights.items()}
        two = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][1]) // 8)
            groups = [order[i:i + batch] for i in range(0, len(order), batch)]
            for g in rng.permutation(len(groups)):
                x, sizes = padded([pages[i][0] for i in groups[g]])
                y, _ = padded([pages[i][1][:, None] for i in groups[g]])
                keep: dict = {}
                p = _sigmoid(self.forward(x, sizes, keep))
                error = np.where(keep["live"], p - y[:, :, 0], 0) / max(1, int(sizes.sum()))
                step += 1
                for k, grad in self.gradients(keep, error.astype(np.float32)).items():
                    grad = np.clip(grad, -1, 1)
                    one[k] = 0.9 * one[k] + 0.1 * grad
                    two[k] = 0.999 * two[k] + 0.001 * grad ** 2
                    self.weights[k] = self.weights[k] - rate * (one[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-8)


def padded(rows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows])
    out = np.zeros((int(sizes.max()), len(rows), rows[0].shape[1]), np.float32)
    for i, r in enumerate(rows):
        out[:len(r), i] = r
    return out, sizes


# What the training labels take for boilerplate, by tag and by class word,
# and the shapes with which sampled pages are varied.
BOILER_TAGS = frozenset("nav aside footer form header menu dialog button select".split())
BOILER_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent disqus footer form header "
    "login masthead menu modal nav navbar navigation newsletter notice popup promo related reply respond search share "
    "sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())
BOILER_SHAPES = (
    ("aside",), ("aside .sidebar",), ("div .sidebar", "ul", "li"), ("div .sidebar", "p"), ("div .widget", "p"),
    ("header", "h1"), ("header .site .header", "p"), ("header", "div"), ("div .header", "h1"), ("div .banner", "p"),
    ("div .cookie .notice", "p"), ("div .cookie .banner",), ("div .notice",), ("div .notice", "p"), ("div .consent", "p"),
    ("form", "p"), ("form .search",), ("form", "fieldset", "legend"), ("form", "button"), ("div .newsletter", "form", "p"),
    ("section .comments", "p"), ("div .comments", "div .comment", "p"), ("section .comments", "article .comment", "p"),
    ("div .comments", "ul", "li"), ("ol .comment .list", "li .comment", "p"), ("div .comment",), ("section .comments", "h2"),
    ("div .ad",), ("div .ads", "p"), ("div .advert",), ("div .advert", "p"), ("div .advertisement",), ("div .sponsored", "p"),
    ("aside .ad", "p"), ("div .promo", "p"), ("div .popup", "p"), ("div .menu", "ul", "li"), ("ul .menu", "li"),
    ("nav .breadcrumb", "ol", "li"), ("div .breadcrumbs",), ("div .related", "ul", "li"), ("div .share", "ul", "li"),
    ("div .social",), ("div .footer", "p"), ("footer", "p"), ("footer", "div", "p"), ("div .login", "form", "p"),
    ("dialog", "p"), ("div .subscribe", "p"), ("nav", "a"), ("nav",), ("div .navbar", "ul", "li"),
)
MAIN_SHAPES = (("article",), ("main",), ("main", "article"), ("div .content",), ("div .post .content",), ("div .main", "article"),
               ("div .entry .content",), ("section .story",), ("div .article .body",), ("main .main", "div .content"))
CONTENT_TAGS = ("p", "p", "p", "p", "ul/li", "h2", "h3", "blockquote", "pre", "ul/li", "ol/li", "table/tr/td", "section/p", "div", "figure/figcaption")


UNTELLING_SHAPES = (("p",), ("p",), ("div",), ("div", "p"), ("section", "p"), ("div .box", "p"), ("div .block",), ("li",))
BOILER_WORDING = tuple("""
We use cookies to improve your experience on this site|By continuing you accept our cookie policy
Accept all cookies or change your privacy settings|This website uses cookies and similar technologies
Sign up for our newsletter and never miss a story|Subscribe now and get our best offers by email
Enter your email address to subscribe|Create a free account or log in to continue reading
Advertisement: buy now and save on your first order|Shop our sale today, free shipping on all orders
Sponsored content, limited offer, click here for the best price|Download our app for free today
Great post, thanks for sharing|I totally agree with this comment, thanks|Posted by a reader, reply to this comment
Leave a comment, log in to reply|Share this article on social media|Follow us for more news and offers
All rights reserved, read our terms and privacy policy|Related articles you may also like
Wir verwenden Cookies, um unsere Website zu verbessern|Alle Cookies akzeptieren oder Einstellungen ändern
Jetzt unseren Newsletter abonnieren und nichts verpassen|Anzeige: jetzt kaufen und sparen, kostenloser Versand
Danke für den tollen Beitrag, ich stimme zu|Melden Sie sich an, um zu kommentieren|Alle Rechte vorbehalten, Datenschutz
Nous utilisons des cookies pour améliorer votre expérience|Accepter tous les cookies ou modifier les paramètres
Inscrivez-vous à notre newsletter gratuite|Publicité: achetez maintenant, livraison gratuite
Merci pour cet article, je suis d'accord|Connectez-vous pour laisser un commentaire|Tous droits réservés
Usamos cookies para mejorar su experiencia en este sitio|Aceptar todas las cookies o cambiar la configuración
Suscríbase a nuestro boletín gratuito|Publicidad: compre ahora, envío gratis y las mejores ofertas
Gracias por compartir, estoy de acuerdo|Inicie sesión para dejar un comentario|Todos los derechos reservados
""".strip().replace("\n", "|").split("|"))
PLAIN_WORDING = tuple("""
The river rose in the night and the bridge was closed until morning|She walked to the station and waited for the train
The council met on Monday to discuss the plan for the old harbour|In the spring the farmers plant their fields by hand
We found the letters in a box under the stairs of our house|He read the book twice and wrote a long answer to his brother
The team won by two goals after a slow first half|Scientists measured the ice on the lake for ten years
Der Fluss stieg in der Nacht und die Brücke blieb gesperrt|Sie ging zum Bahnhof und wartete auf den Zug
Der Rat sprach am Montag über den alten Hafen|Wir fanden die Briefe in einer Kiste unter der Treppe
La rivière est montée dans la nuit et le pont est resté fermé|Elle marcha vers la gare et attendit le train
Le conseil a parlé lundi du vieux port|Nous avons trouvé les lettres dans une boîte sous l'escalier
El río subió en la noche y el puente quedó cerrado|Ella caminó a la estación y esperó el tren
El consejo habló el lunes del viejo puerto|Encontramos las cartas en una caja bajo la escalera
""".strip().replace("\n", "|").split("|"))


def is_boiler(path: Sequence[str]) -> bool:
    for element in path:
        tag, *names = element.split(" ")
        if tag in BOILER_TAGS or any(n[1:] in BOILER_WORDS for n in names):
            return True
    return False


def labels(page: Sequence[Block]) -> np.ndarray:
    """1 where the markup means main text: in article or main, where there is one."""
    inside = [any(p.split(" ")[0] in ("article", "main") for p in b.path) for b in page]
    some = any(inside)
    return np.array([(ok or not some) and not is_boiler(b.path) for b, ok in zip(page, inside)], np.float32)


def varied(page: Sequence[Block], texts: Sequence[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A page with its container, some tags and its boilerplate changed at random."""
    own = labels(page)
    shape = MAIN_SHAPES[rng.integers(len(MAIN_SHAPES))]
    out: list[Block] = []
    truth: list[float] = []

    def add(where: tuple[str, ...]) -> None:
        for _ in range(int(rng.integers(1, 5))):
            words = texts[rng.integers(len(texts))].split(" ")
            cut = int(rng.integers(1, 40)) if rng.random() < 0.7 else len(words)
            text = " ".join(words[:cut])
            form = BOILER_SHAPES[rng.integers(len(BOILER_SHAPES))]
            out.append(Block(where + form, text, len(text) if rng.random() < 0.3 else 0))
            truth.append(0.0)

    def say(where: tuple[str, ...], wording: Sequence[str], main: float) -> None:
        said = [wording[i] for i in rng.integers(len(wording), size=int(rng.integers(1, 4)))]
        words = [w for w in ". ".join(said).split(" ") if rng.random() < 0.9] or said[0].split(" ")
        form = UNTELLING_SHAPES[rng.integers(len(UNTELLING_SHAPES))]
        out.append(Block(where + form, " ".join(words) + ("." if rng.random() < 0.7 else ""), 0))
        truth.append(main)

    base = ("html", "body")
    wrap = base + (("div .wrapper",) if rng.random() < 0.4 else ())
    if rng.random() < 0.8:
        add(wrap)
    for block, main in zip(page, own):
        if main:
            tag = CONTENT_TAGS[rng.integers(len(CONTENT_TAGS))].split("/") if rng.random() < 0.4 else [
                block.path[-1].split(" ")[0] if block.path and block.path[-1].split(" ")[0] in ("p", "h1", "h2", "li") else "p"]
            out.append(Block(wrap + shape + tuple(tag), block.text, block.links))
            truth.append(1.0)
            if rng.random() < 0.2:
                add(wrap + shape)
            if rng.random() < 0.15:
                say(wrap + shape, BOILER_WORDING, 0.0)
            if rng.random() < 0.15:
                say(wrap + shape, PLAIN_WORDING, 1.0)
        elif rng.random() < 0.6:
            out.append(block)
            truth.append(0.0)
    if rng.random() < 0.8:
        add(wrap + (shape if rng.random() < 0.3 else ()))
    return out, np.array(truth, np.float32)


@dataclass(frozen=True)
class LabellerSpec:
    """``sample_pages`` bounds the pages trained on, ``sample_chars`` each one's length."""

    sample_pages: int = 300
    sample_chars: int = 200_000
    variants: int = 5
    epochs: int = 10


def train(pages: Sequence[str], spec: LabellerSpec = LabellerSpec()) -> BiLstm | None:
    """A labeller from a bounded sample; None if the sample holds no text at all."""
    rng = np.random.default_rng(5)
    parsed = [p for p in map(blocks, pages) if p]
    if not parsed:
        return None
    texts = [b.text for p in parsed for b in p]
    features = Features()
    rows = [(features(p), labels(p)) for p in parsed]
    for _ in range(spec.variants):
        rows += [(features(b), y) for b, y in (varied(p, texts, rng) for p in parsed) if b]
    model = BiLstm()
    model.fit(rows, spec.epochs)
    return model


def main_texts(pages: Sequence[str], model: BiLstm | None, features: Features) -> list[str]:
    """Main text of every page; pages of like length are labelled together."""
    parsed = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, p in enumerate(parsed) if p), key=lambda i: len(parsed[i]))
    at = 0
    while at < len(order) and model is not None:
        # Padding costs steps times batch, so long pages go in small groups.
        room = max(1, min(256, 20_000 // len(parsed[order[min(at + 255, len(order) - 1)]])))
        group = order[at:at + room]
        x, sizes = padded([features(parsed[i]) for i in group])
        keep = model.forward(x, sizes) > 0
        for column, i in enumerate(group):
            out[i] = "\n".join(b.text for b, ok in zip(parsed[i], keep[:sizes[column], column]) if ok)
        at += room
    return out


def sample(pages: DataFrame, spec: LabellerSpec) -> list[str]:
    """Html of the pages with the smallest hashes: at most ``sample_pages`` rows."""
    usable = pages.filter(F.col("html").isNotNull() & (F.length("html") <= spec.sample_chars))
    rows = usable.select("html", F.xxhash64("html").alias("h")).orderBy("h", "html").limit(spec.sample_pages)
    return [r["html"] for r in rows.collect()]


def extract(pages: DataFrame, spec: LabellerSpec = LabellerSpec()) -> DataFrame:
    """(page_id, url, text) for every row of ``pages``."""
    model = train(sample(pages, spec), spec)  # some ten thousand weights, sent with the tasks

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                texts = main_texts(part.column("page").to_pylist(), model, features)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                    ["page_id", "url", "text"])

    whole = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("page"))
    return whole.mapInArrow(rows, "page_id bigint, url string, text string")


