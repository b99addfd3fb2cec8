"""Main text of web pages by a consensus of each host's pages.

First every page scores its containers: the share of the page's running text that a container holds, against what else
it holds (harmonic mean of both). Containers are named by their generalised path, the tags and classes from the body down
with digits made equal. Spark adds up the scores per host and path, and the path with the highest sum wins, the deeper
one if two are equal. Then each page is read again and the blocks of all its elements on the winning path are its text;
a page without running text on that path uses its own best container.

Scripts, styles, controls and hidden elements are never text. Menus, headers, footers, sidebars, notices, adverts, forms and
comments are suspected by tag, role, class or id, and a suspicion is weighed by the share of the page's running text that
all elements on the same path hold: a name that only contains such a word is outweighed by half of the text, a tag or a
whole name by nine tenths. Paths that one in FEW pages of a host has are judged by their mean share on these pages, rarer
ones by the page alone. Text in links is never running text. A tag that the end of the page cuts off is dropped. A null or empty page has an empty text; pages with a null URL share one host; repeated rows stay
repeated; an empty table gives an empty result; extra columns stay, one called like a result column is replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.shared import stored

#: Characters of html that are put into one output batch.
BATCH_CHARS = 4 << 20
#: Least score with which a container takes part in the vote.
LEAST = 0.1
#: Shares of a page's running text that outweigh a word in a name, and a tag, a role or a whole name.
WEAK, STRONG = 0.5, 0.9
#: A path is judged by its host if one in so many pages of the host has it.
FEW = 50

# Elements by their role in the page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
NEVER_TEXT = frozenset(
    "audio button canvas datalist head iframe input label map meter noembed noframes noscript object option output "
    "progress script select style svg template textarea title video".split()
)
SUSPECTED_TAGS = frozenset("aside dialog footer form header menu nav search".split())
SUSPECTED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
SUSPECTED_NAMES = frozenset(
    "ad ads adsbygoogle advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent "
    "cookie cookies disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "overlay pager pagination popup promo promoted recommended related replies respond share sharing sidebar signup "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
#: Never suspected by a class or id.
KEPT_TAGS = frozenset("article body html main".split())
#: Parts of a class or id that tell what an element has or lacks, not what it is.
STATES = frozenset("has have no show hide with without".split())
ATTRIBUTES = frozenset("class id role hidden aria-hidden".split())

_token = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S
)
# One attribute after another, so that no value is taken for a name; an open quote takes the rest.
_attribute = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_digits = re.compile(r"\d+")
_names = re.compile(r"[_\-]+")


def _suspicion(name: str) -> float:
    """What must outweigh a class or id that tells of an advert, a menu or the like; ``has-sidebar`` tells what is inside."""
    if name in SUSPECTED_NAMES:
        return STRONG
    parts = _names.split(name)
    return WEAK if not SUSPECTED_NAMES.isdisjoint(parts) and STATES.isdisjoint(parts) else 0.0


class Page:
    """Elements in page order, and pieces of text with their element and block.

    ``never`` marks what is never text, ``limit`` has the share of text that outweighs the suspicion of an element, 0 for none.
    """

    def __init__(self, source: str) -> None:
        self.parent, self.path, self.container, self.never, self.link = [-1], [""], [True], [False], [False]
        self.limit = [0.0]
        self.pieces: list[tuple[int, int, str]] = []
        stack: list[tuple[str, int]] = [("", 0)]
        open_: dict[str, int] = {}
        block = position = 0
        end = len(source)
        while position < end:
            found = _token.search(source, position)
            start = found.start() if found else end
            if start > position:
                self.pieces.append((stack[-1][1], block, source[position:start]))
            if not found:
                break
            position = found.end()
            name = (found[2] or found[6] or "").lower()
            if not name or not (found[4] or found[8]):
                # A comment or declaration; or a tag that the page's end cuts off.
                continue
            if name in BLOCKS:
                block += 1
            if found[1] or found[5]:
                if open_.get(name):
                    while stack:
                        closed, _ = stack.pop()
                        open_[closed] -= 1
                        if closed == name:
                            break
                continue
            if name in BLOCKS and open_.get("p"):
                while True:
                    closed, _ = stack.pop()
                    open_[closed] -= 1
                    if closed == "p":
                        break
            if name in VOID:
                if name == "br":
                    self.pieces.append((stack[-1][1], block, " "))
                continue
            number = self._element(stack[-1][1], name, found[3] or found[7] or "")
            if name in RAW:
                closing = re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(source, position)
                position = closing.start() if closing else end
            stack.append((name, number))
            open_[name] = open_.get(name, 0) + 1

    def _element(self, parent: int, name: str, rest: str) -> int:
        classes, never = "", self.never[parent] or name in NEVER_TEXT
        limit = 0.0
        if name in SUSPECTED_TAGS:
            # A form may hold the whole page.
            limit = WEAK if name == "form" else STRONG
        if rest:
            seen = set()
            for key, value in _attribute.findall(rest):
                key = key.lower()
                # The first of repeated attributes counts.
                if key not in ATTRIBUTES or key in seen:
                    continue
                seen.add(key)
                value = value.strip("\"'").lower()
                if key == "class":
                    classes = ".".join(sorted(set(value.split())))
                if key in ("class", "id"):
                    if name not in KEPT_TAGS:
                        limit = max([limit, *map(_suspicion, value.split())])
                elif key == "role":
                    limit = max(limit, STRONG if value in SUSPECTED_ROLES else 0.0)
                elif key == "hidden" or key == "aria-hidden" and value == "true":
                    never = True
        # A hash, so that the name of a path is short however deep it is.
        path = xxhash.xxh64_hexdigest(f"{self.path[parent]}/{name}.{_digits.sub('#', classes)}")
        self.parent.append(parent)
        self.path.append(path)
        self.container.append(name in CONTAINERS)
        self.never.append(never)
        self.limit.append(limit)
        self.link.append(self.link[parent] or name == "a")
        return len(self.path) - 1

    def suspected(self) -> dict[str, tuple[float, float]]:
        """Share of the page's running text and limit of each suspected path."""
        if not any(self.limit):
            return {}
        sizes = [0] * len(self.path)
        for element, _, text in self.pieces:
            if not (self.never[element] or self.link[element]):
                sizes[element] += len(text) - text.count(" ") - text.count("\n")
        for element in range(len(self.path) - 1, 0, -1):
            sizes[self.parent[element]] += sizes[element]
        found: dict[str, tuple[float, float]] = {}
        for element, limit in enumerate(self.limit):
            if limit and not self.never[element]:
                path = self.path[element]
                size, known = found.get(path, (0.0, 0.0))
                found[path] = (size + sizes[element] / max(sizes[0], 1), max(known, limit))
        return found

    def settle(self, judged: dict[str, bool]) -> None:
        """Decides what is dropped: by its host's judgement, else by its share of this page."""
        own = {path: share > limit for path, (share, limit) in self.suspected().items()} | judged
        self.dropped = list(self.never)
        for element in range(1, len(self.path)):
            suspect = self.limit[element] and not own.get(self.path[element], False)
            self.dropped[element] = bool(self.dropped[element] or suspect or self.dropped[self.parent[element]])

    def scores(self) -> dict[str, tuple[float, int]]:
        """Score and order of each path with a container; a deeper path comes later."""
        good, all_ = [0] * len(self.path), [0] * len(self.path)
        for element, _, text in self.pieces:
            size = len(text) - text.count(" ") - text.count("\n")
            all_[element] += size
            if not (self.dropped[element] or self.link[element]):
                good[element] += size
        depth = [0] * len(self.path)
        for element in range(1, len(self.path)):
            depth[element] = depth[self.parent[element]] + 1
        for element in range(len(self.path) - 1, 0, -1):
            good[self.parent[element]] += good[element]
            all_[self.parent[element]] += all_[element]
        by_path: dict[str, list[int]] = {}
        for element, path in enumerate(self.path):
            if self.container[element] and not self.dropped[element] and good[element]:
                sums = by_path.setdefault(path, [0, 0, depth[element]])
                sums[0] += good[element]
                sums[1] += all_[element]
        return {path: (2 * g / (a + good[0]), d) for path, (g, a, d) in by_path.items()}

    def text(self, path: str) -> str:
        """Blocks of all elements on a path, without dropped parts."""
        # The page itself is the first element, for pages without a body.
        inside = [path == ""] * len(self.path)
        for element in range(1, len(self.path)):
            inside[element] = self.path[element] == path or inside[self.parent[element]]
        blocks: dict[int, list[str]] = {}
        for element, block, text in self.pieces:
            if inside[element] and not self.dropped[element]:
                blocks.setdefault(block, []).append(html.unescape(text) if "&" in text else text)
        joined = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(b for b in joined if b)


def _best(scores: dict[str, tuple[float, int]]) -> str | None:
    return max(scores, key=lambda path: (round(scores[path][0], 9), scores[path][1], path)) if scores else None


def host_votes(pages: DataFrame) -> DataFrame:
    """(host, path, score, depth, pages, share, limit) summed over the pages of each host.

    Containers have a score and a depth, suspected paths the number of their pages and the sum of their shares in
    millionths. The row without a path counts the pages.
    """
    counted = ["score", "depth", "pages", "share", "limit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Votes of one batch are added up here already.
            votes: dict[tuple, list] = {}
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                page = Page(source.as_py() or "")
                page.settle({})
                votes.setdefault((host, None), [0, 0, 0, 0, 0])[2] += 1
                for path, (score, depth) in page.scores().items():
                    if score >= LEAST:
                        vote = votes.setdefault((host, path), [0, 0, 0, 0, 0])
                        vote[0] += round(score * 1_000_000)
                        vote[1] = max(vote[1], depth)
                for path, (share, limit) in page.suspected().items():
                    vote = votes.setdefault((host, path), [0, 0, 0, 0, 0])
                    vote[2] += 1
                    vote[3] += round(share * 1_000_000)
                    vote[4] = max(vote[4], round(limit * 1_000_000))
            columns = list(zip(*votes.values())) or [()] * len(counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                names=["host", "path", *counted],
            )

    votes = pages.select("host", "html").mapInArrow(run, "host string, path string, " + ", ".join(f"{c} long" for c in counted))
    adding = [F.max(c).alias(c) if c in ("depth", "limit") else F.sum(c).alias(c) for c in counted]
    return votes.groupBy("host", "path").agg(*adding)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winner, judged): the winning path of each host, and which of its frequent suspected paths are kept.

    At most FEW paths for each suspected path of an average page are judged.
    """
    votes = stored(host_votes(pages), "host-votes")
    best = F.max(F.when(F.col("score") > 0, F.struct("score", "depth", "path")))
    of_pages = F.sum(F.when(F.col("path").isNull(), F.col("pages")))
    hosts = stored(votes.groupBy("host").agg(best.alias("best"), of_pages.alias("of")), "hosts")
    frequent = votes.where("path is not null and pages > 0").join(hosts.select("host", "of"), "host").where(F.col("pages") * FEW >= F.col("of"))
    kept = (F.col("share") > F.col("limit") * F.col("pages")).alias("kept")
    judged = frequent.groupBy("host").agg(F.collect_list(F.struct("path", kept)).alias("judged"))
    return hosts.join(judged, "host", "left").select("host", F.col("best.path").alias("winner"), "judged")


def extract(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``text``."""
    host = F.coalesce(F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))
    kept = [c for c in pages.columns if c != "text"]
    columns = [F.col(f"`{c}`") for c in kept]
    hosted = pages.select(*columns, host.alias("_host"))
    winners = stored(host_paths(hosted.select(F.col("_host").alias("host"), "html")).toDF("_host", "_winner", "_judged"), "host-paths")
    # The stored winners' size decides between a broadcast and a sort-merge join.
    chosen = hosted.join(winners, "_host", "left").select(*columns, "_winner", "_judged")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = size = 0
            texts: list[str] = []
            for row, (source, winner, judged) in enumerate(zip(*(batch.column(c) for c in ("html", "_winner", "_judged")), strict=True)):
                source = source.as_py() or ""
                page = Page(source)
                page.settle({j["path"]: j["kept"] for j in judged.as_py() or ()})
                text = page.text(winner.as_py()) if winner.is_valid else ""
                if not text and (own := _best(page.scores())):
                    text = page.text(own)
                texts.append(text)
                size += len(source)
                if size > BATCH_CHARS or row + 1 == batch.num_rows:
                    rows = batch.slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, "text"])
                    first, size, texts = row + 1, 0, []

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != "text"]
    return chosen.mapInArrow(run, ", ".join([*schema, "text string"]))
