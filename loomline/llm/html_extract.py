"""Main text of web pages by site style trees.

The pages of a host are merged into one tree.  An element's place is the path of block
elements, with their classes (three digits or more are any number), that lead to it (below
``MAX_DEPTH`` elements share the place of the last); an element's texts are leaves below
it.  A place that branches gets its presentation importance from the entropy of its child
sequences over the host's pages; a leaf gets its content importance from how its texts
spread: a text in one page counts 1, one in all pages 0.  Headings, paragraphs, items and cells
directly in one element are read together, so each counts as much as the most important of them
("Ingredients" above each page's own list).  Composite importance weighs a
place's own with its children's, by the pages that hold them.  A branch in which no
place is above ``LEAST_IMPORTANCE`` is noise, and each page is left without such branches;
a text that few pages have is kept in a place whose others repeat.

What a page says of itself is a prior on the leaves' importance.  Texts in navigation,
footers, asides, forms, dialogs and headers, and in elements whose classes, ids or roles
name a menu, advert, notice or comment as a whole, count ``NAMED_PRIOR`` times, which is noise on any host.
Other texts within ``article`` or ``main`` are content, however often they repeat, and where a page has
such an element, its text is looked for in it.  Names of a branch that holds the page's only
``article`` or ``main`` text, or most of that text within one, are ignored, and all of them are where
they would leave nothing.  A page that has nothing but what other pages of its host have
as well is a near copy of them and keeps its text.

The rule is the same for hosts of any size: on a host of one page nothing is repeated, and
the names alone decide.  Equal rows and exact copies on one host count as one page.

Statistics are counted per (host, place, value), and importance is computed by joins and sums
over places and their ancestors, so a host with a third of all pages is no hot key and no
tree is held in one task.  Pages meet only the list of their host's topmost noisy places that two
pages or more share; what is noise by its name alone is told from the page.

Blocks are separated by white space; inline elements, images, scripts and elements that no standard
names are not, unless an unknown element names itself as no content.  Character references are
decoded, and every run of Unicode white space becomes one space.

Cases: null or empty html gives the empty text; a null url is a host of its own.  Broken
markup is read as browsers do, roughly: open elements end with their parents, ``head`` ends
where content begins, a tag cut off by the end of the page is dropped.  Deep nesting and
long pages take memory in proportion.  Repeated rows give repeated rows, an empty table
an empty one.  Only the id, url and html are read, so no name clashes.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import shared

LEAST_IMPORTANCE = 0.1
#: Weight that composite importance gives to the children, per child sequence.
DECAY = 0.9
#: What the importance of texts in parts that name themselves as no content is multiplied by.
NAMED_PRIOR = 0.05
MAX_DEPTH = 64

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Fixed sets of element names.
RAW = frozenset("script style noscript template textarea iframe svg object select title xmp noembed noframes annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i img ins kbd label map mark meter output picture progress q rp rt ruby s samp slot small span strike strong sub sup time tt u var video wbr math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mspace semantics".split())
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_ENDS = frozenset("li dt dd tr td th option".split())
BLOCK = ENDS_P | SAME_ENDS | frozenset("html head body thead tbody tfoot caption colgroup legend figcaption summary optgroup datalist dir hgroup search center button listing plaintext frameset".split())
FLOW = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th caption figcaption blockquote pre".split())
IN_HEAD = frozenset("base basefont bgsound command link meta title style script noscript template".split())
NOISE = frozenset("nav footer aside form menu dialog button".split())
MAIN = frozenset("article main".split())
#: Fixed words in classes, ids and roles that name what is no content.
NOISE_WORDS = frozenset("ad ads adbox adsbox adslot adunit adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navmenu topnav sidenav navigation sidebar breadcrumb breadcrumbs footer cookie cookies cookiebar cookiebanner consent gdpr notice popup modal newsletter subscribe share sharing social related recommended comment comments commentlist commentbox disqus respond reply replies toolbar pagination pager complementary contentinfo search".split())
#: Of these, the words that always count where other text is left, as comments can be most of a page and articles each.
COMMENT_WORDS = frozenset("comment comments commentlist commentbox disqus respond reply replies".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Words that don't change what a name with one of the words above stands for, and words that do.
NEUTRAL = frozenset("site main primary secondary global local top bottom left right upper lower sticky fixed floating list box bar area section block container wrap wrapper inner outer holder widget widgets posts post articles links link buttons button icons icon group row column panel strip slot unit zone region module header text title form message msg overlay window policy privacy google user reader thread more latest popular recent mobile desktop large small".split())
NEGATIONS = frozenset("has no not with without is hide hidden layout template body".split())
NUMBER, CAMEL, SPLIT = re.compile("[0-9]{3,}"), re.compile(r"([a-z])([A-Z])"), re.compile(r"[^a-z]+")


def naming(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in an attribute's value stands for one of the words as a whole.

    All of a name's parts are such words or neutral ones, or the last part is one and the first is no negation.
    """
    for name in value.split():
        parts = [p for p in SPLIT.split(CAMEL.sub(r"\1-\2", name).lower()) if p]
        hits = [p in words for p in parts]
        if any(hits) and parts[0] not in NEGATIONS and (hits[-1] or all(h or p in NEUTRAL for h, p in zip(hits, parts))):
            return True
    return False


def place_below(place: int, label: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{place}/{label}") >> 1


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


def names_noise(attributes: str) -> bool:
    """Whether a class, id or role names a menu, advert or the like."""
    return "=" in attributes and any(naming(v, NOISE_WORDS) for _, *values in NAMED.findall(attributes) for v in values)


class PageParts:
    """A page's texts with the paths of their places, and its branching places."""

    def __init__(self, page: str):
        #: Path of places, whether in main, whether named as no content, text.
        self.texts: list[tuple[tuple[int, ...], bool, bool, str]] = []
        self.sequences: list[tuple[tuple[int, ...], str]] = []
        found_in: list[tuple[int, bool, bool]] = []  # innermost branch named as noise, noise by element, and flow text, of each text
        # of each branch named as noise: the one around it or -1, and whether it is within main, None for comments
        named: list[tuple[int, bool | None]] = []
        # open elements: name, path, noise, main, child names, innermost named branch or -1
        stack: list[tuple[str, tuple[int, ...], bool, bool, list[str], int]] = [("", (0,), False, False, [], -1)]
        opened: Counter = Counter()
        piece: list[str] = []
        at, end = 0, len(page)

        def flush() -> None:
            if piece:
                text = "".join(piece)
                piece.clear()
                if "&" in text:
                    text = entities.unescape(text)
                text = " ".join(text.split())
                if text:
                    if stack[-1][0] == "head":
                        close()
                    name, path, noise, main, _, branch = stack[-1]
                    self.texts.append((path, main, noise or branch >= 0, text))
                    found_in.append((branch, noise, name in FLOW))

        def close() -> None:
            name, path, _, _, children, _ = stack.pop()
            opened[name] -= 1
            if children:
                self.sequences.append((path, " ".join(children)))

        while at < end:
            found = TOKEN.search(page, at)
            if found is None:
                piece.append(page[at:])
                break
            if found.start() > at:
                piece.append(page[at : found.start()])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                if name in BLOCK or opened[name] > 0:
                    flush()
                if opened[name] > 0:
                    while stack[-1][0] != name:
                        close()
                    close()
                continue
            if name in RAW:
                closing = re.compile(f"</{re.escape(name)}\\b[^>]*>?", re.I).search(page, at) if not found[3].endswith("/") else None
                if closing is not None:
                    at = closing.end()
                elif not found[3].endswith("/"):
                    at = end
                continue
            if name in VOID and name not in ("br", "hr"):
                continue
            if name not in BLOCK and name != "br" and opened[name] == 0 and (name in INLINE or not names_noise(found[3])):
                continue
            flush()
            if stack[-1][0] == "head" and name not in IN_HEAD:
                close()
            if name in VOID or (name in ("html", "head", "body") and opened[name] > 0):
                continue
            if name in ENDS_P or name in SAME_ENDS:
                ending = "p" if name in ENDS_P else name
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == ending:
                        while len(stack) > k:
                            close()
                        break
                    if stack[k][0] not in ("p", "li", "dt", "dd", "tr", "td", "th") or (ending != "p" and stack[k][0] in ("table", "ul", "ol", "dl")):
                        break
            _, path, noise, main, children, branch = stack[-1]
            if not children or children[-1] != name:
                children.append(name)
            label, role, noisy, comments, top = name, False, False, False, False
            if "=" in found[3]:
                for kind, *values in NAMED.findall(found[3]):
                    value, kind = next((v for v in values if v), ""), kind.lower()
                    noisy, comments, top = noisy or naming(value, NOISE_WORDS), comments or naming(value, COMMENT_WORDS), top or naming(value, HEADER_WORDS)
                    if kind == "class":
                        label = f"{name}.{'.'.join(sorted(NUMBER.sub('#', value).split()))}"
                    role = role or (kind == "role" and value.lower() == "main")
            if name not in ("html", "body"):
                noise = noise or name in NOISE or (not main and name == "header")
                if (noisy and name != "main") or (not main and top):
                    named.append((branch, None if comments else main))
                    branch = len(named) - 1
            main = main or name in MAIN or role
            if len(path) <= MAX_DEPTH:
                path = (*path, place_below(path[-1], label))
            stack.append((name, path, noise, main, [], branch))
            opened[name] += 1
        flush()
        while len(stack) > 1:
            close()
        if named:
            self._weigh_names(found_in, named)
        # texts are leaves; those named as no content, within main or flow texts are leaves of their own
        self.texts = [((*path, place_below(path[-1], f"#{main:d}{noise:d}{flow:d}")), main, noise, text) for (path, main, noise, text), (_, _, flow) in zip(self.texts, found_in)]
        self.flows = [flow for _, _, flow in found_in]

    def _weigh_names(self, found_in: list[tuple[int, bool, bool]], named: list[tuple[int, bool | None]]) -> None:
        """Ignores names of branches with the page's only main text or most of it, and all names that leave nothing.

        Branches come after those around them, so that one pass in order tells each what is around it, and one backwards what is in it.
        """
        n = len(named)
        in_inner, in_outer = [False] * n, [False] * n  # is this branch, or one around it, within main; or not
        for k, (above, inside) in enumerate(named):
            in_inner[k] = bool(inside) or (above >= 0 and in_inner[above])
            in_outer[k] = not inside or (above >= 0 and in_outer[above])
        total, clean, main_text, around = 0, False, [0] * n, [False] * n
        for (_, main, _, text), (branch, noise, _) in zip(self.texts, found_in):
            if main and not noise:
                total += len(text)
                # a named article, such as one of many comments, is no main text
                clean = clean or branch < 0 or not in_outer[branch]
                if branch >= 0:
                    main_text[branch] += len(text)
                    # a branch around an article: the article itself is not named
                    around[branch] = around[branch] or not in_inner[branch]
        for k in range(n - 1, -1, -1):
            above = named[k][0]
            if above >= 0:
                main_text[above] += main_text[k]
                around[above] = around[above] or around[k]
        counts = [False] * n  # does the name of this branch, or of one around it, count
        for k, (above, inside) in enumerate(named):
            ignored = inside is not None and main_text[k] > 0 and (2 * main_text[k] > total if inside else around[k] and not clean)
            counts[k] = not ignored or (above >= 0 and counts[above])
        noisy = [noise or (branch >= 0 and counts[branch]) for branch, noise, _ in found_in]
        if all(noisy):
            noisy = [noise for _, noise, _ in found_in]
        self.texts = [(path, main, n, text) for (path, main, _, text), n in zip(self.texts, noisy)]

    def text(self, noisy: frozenset[int] | None = None) -> str:
        """The content: texts that are not named as noise, outside branches whose place is in ``noisy`` (which also has single texts of places), within main if any such text is.

        Without such a set the page is judged alone, by its names.
        """
        plain = [t for t in self.texts if not t[2]]
        content = [t for t in plain if noisy.isdisjoint(t[0]) and t[0][-1] ^ text_hash(t[3]) not in noisy] or plain if noisy else plain
        if any(t[1] for t in content):
            content = [t for t in content if t[1]]
        return " ".join(t[3] for t in content)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


#: Kinds of statistics: pages with a place, its child sequences, its texts; texts within main and named ones have kinds of their own.
PLACE, SEQUENCE, TEXT = 0, 1, 2
#: Bits of a leaf's prior.
IN_MAIN, IS_NAMED, IS_FLOW = 1, 2, 4


def statistics(pages: DataFrame) -> DataFrame:
    """(host, id, path, prior, kind, value, n): pages by place, child sequence and text hash; prior: bits of what a leaf is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: Counter = Counter()
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist()):
                parts = PageParts(page or "")
                seen = {(path, 0, SEQUENCE, text_hash(x)) for path, x in parts.sequences}
                seen.update((path, IN_MAIN * main | IS_NAMED * named | IS_FLOW * flow, TEXT, text_hash(text)) for (path, main, named, text), flow in zip(parts.texts, parts.flows))
                for path, prior, kind, _ in list(seen):
                    seen.add((path, prior if kind == TEXT else 0, PLACE, 0))
                    if kind == TEXT:
                        seen.update((path[:k], 0, PLACE, 0) for k in range(1, len(path)))
                counted.update((host, *x) for x in seen)
            if counted:
                host, path, prior, kind, value = zip(*counted)
                ids = [p[-1] for p in path]
                types = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                columns = (host, ids, path, prior, kind, value, list(counted.values()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["host", "id", "path", "prior", "kind", "value", "n"])

    rows = shared.map_arrow(pages.select("host", "html").distinct(), run, "host string, id long, path array<long>, prior int, kind int, value long, n long")
    return rows.groupBy("host", "id", "kind", "value").agg(F.any_value("path").alias("path"), F.max("prior").alias("prior"), F.sum("n").alias("n"))


def importance(counts: DataFrame) -> DataFrame:
    """host, id, parent, pages, composite and highest importance of every place, and what texts are in it.

    A place's composite importance is (1 - k) own + k sum(w composite) over its children, so every place adds to
    each place above it, with the product of the k and w between them.  ``mixed``: a leaf with texts that few of its pages have;
    ``some_mixed``: the place has such a leaf; ``some_open``: it has a leaf that is not named as noise.
    """
    of = lambda kind, value, how=F.sum: how(F.when(F.col("kind") == kind, value))
    n, has = F.col("n").cast("double"), lambda bit: F.col("prior").bitwiseAND(F.lit(bit)) != 0
    nodes = counts.groupBy("host", "id").agg(
        F.any_value("path").alias("path"), F.max("prior").alias("prior"), of(PLACE, n).alias("pages"),
        of(SEQUENCE, n).alias("s"), of(SEQUENCE, n * F.log(n)).alias("sl"), F.coalesce(of(SEQUENCE, F.lit(1.0)), F.lit(0.0)).alias("sequences"),
        of(TEXT, F.log(n)).alias("tl"), of(TEXT, F.lit(1.0)).alias("t"), of(TEXT, n, F.min).alias("rarest"),
    )
    pages, leaf, named, main = F.col("pages"), F.col("t").isNotNull(), has(IS_NAMED), has(IN_MAIN)
    spread = F.when(pages < 2, 1.0).otherwise(1 - F.col("tl") / F.col("t") / F.log(pages))
    content = F.when(named, spread * NAMED_PRIOR).when(main, 1.0).otherwise(spread)
    presentation = F.when(pages < 2, 1.0).otherwise((F.log("s") - F.col("sl") / F.col("s")) / F.log(pages))
    own = F.when(leaf, content).otherwise(F.coalesce(presentation, F.lit(0.0)))
    # a flow text's element is its parent, and what it is read together with is in the element around that
    around = F.when(leaf & has(IS_FLOW) & ~named, F.try_element_at("path", F.lit(-3))).alias("around")
    nodes = nodes.select(
        "host", "id", "path", F.coalesce(F.try_element_at("path", F.lit(-2)), F.lit(-1)).alias("parent"), "pages", own.alias("own"), F.when(leaf, 0.0).otherwise(F.pow(F.lit(DECAY), "sequences")).alias("k"),
        around, (leaf & ~named).alias("open"), F.coalesce(leaf & ~named & ~repeated(F.col("rarest"), pages), F.lit(False)).alias("mixed"),
    )
    nodes = shared.cut(nodes, "places")
    together = nodes.where("around IS NOT NULL").groupBy("host", "around").agg(F.max("own").alias("shared"))
    lifted = nodes.join(together, ["host", "around"], "left").select("host", "id", "k", F.greatest("own", F.coalesce("shared", F.lit(0.0))).alias("own"))

    siblings = nodes.groupBy("host", "parent").agg(F.sum("pages").alias("beside"))
    above = nodes.select("host", F.col("id").alias("parent"), F.col("k").alias("k_above"))
    step = nodes.join(siblings, ["host", "parent"]).join(above, ["host", "parent"], "left")
    step = step.select("host", F.col("id").alias("a"), F.coalesce(F.log("k_above") + F.log(F.col("pages") / F.col("beside")), F.lit(0.0)).alias("step"))
    lines = nodes.select("host", "id", "open", "mixed", F.explode("path").alias("a"))
    reach = shared.cut(lines.join(step, ["host", "a"]).groupBy("host", "id").agg(F.sum("step").alias("reach")), "reach")

    adds = lifted.join(reach, ["host", "id"]).select("host", "id", ((1 - F.col("k")) * F.col("own")).alias("adds"), "reach")
    upwards = lines.join(adds, ["host", "id"]).join(reach.select("host", F.col("id").alias("a"), F.col("reach").alias("reach_above")), ["host", "a"])
    composite = upwards.groupBy("host", "a").agg(F.sum(F.col("adds") * F.exp(F.col("reach") - F.col("reach_above"))).alias("composite"))
    composite = shared.cut(composite.withColumnRenamed("a", "id"), "composite")
    within = [F.max("composite").alias("highest"), F.bool_or("mixed").alias("some_mixed"), F.bool_or("open").alias("some_open")]
    highest = lines.join(composite, ["host", "id"]).groupBy("host", "a").agg(*within).withColumnRenamed("a", "id")
    return nodes.select("host", "id", "parent", "pages", "mixed").join(composite, ["host", "id"]).join(highest, ["host", "id"])


def repeated(n: Column, pages: Column) -> Column:
    """Whether a text of ``n`` of a place's pages is of no importance."""
    return (pages >= 2) & (1 - F.log(n) / F.log(pages) <= LEAST_IMPORTANCE)


def noisy_places(counts: DataFrame) -> DataFrame:
    """host, noisy: the topmost places of each host's branches in which nothing is important, and of leaves that also have texts of few pages the texts that repeat.

    Branches with nothing but texts named as noise, which each page tells itself, are left out.
    """
    noise = (F.col("highest") <= LEAST_IMPORTANCE).alias("noise")
    places = shared.cut(importance(counts).where(noise).select("host", "id", "parent", "pages", "mixed", "some_mixed", "some_open"), "noise")
    whole = places.where("NOT some_mixed")
    above = whole.select("host", F.col("id").alias("parent"))
    topmost = whole.where("some_open").join(above, ["host", "parent"], "left_anti").select("host", "id")
    texts = counts.where(F.col("kind") == TEXT).select("host", "id", "value", "n").join(places.where("mixed").select("host", "id", "pages"), ["host", "id"])
    texts = texts.where(repeated(F.col("n").cast("double"), F.col("pages"))).select("host", F.col("id").bitwiseXOR(F.col("value")).alias("id"))
    return topmost.unionByName(texts).groupBy("host").agg(F.collect_list("id").alias("noisy"))


def extract(pages: DataFrame, keep: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page id, url, text and n_chars of every page."""
    read = pages.select(F.col(keep).alias("keep"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"), host_of(F.col(url)).alias("host"))
    noisy = shared.cut(noisy_places(shared.cut(statistics(read), "style-trees")), "noisy")
    fields = [read.schema["keep"], T.StructField("url", T.StringType()), T.StructField("text", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch["noisy"]
            for i, page in enumerate(batch["html"]):
                out.append(PageParts(page.as_py() or "").text(frozenset(lists[i].as_py() or ())))
            yield pa.RecordBatch.from_arrays([batch["keep"], batch["url"], pa.array(out, pa.string())], ["keep", "url", "text"])

    out = shared.map_arrow(read.join(noisy, "host", "left").select("keep", "url", "html", "noisy"), run, T.StructType(fields))
    return out.select(F.col("keep").alias(keep), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(shared.table(spark, sf_dir, "pages"))
