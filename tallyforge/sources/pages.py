"""Web pages as rows: urls, cache freshness, and tables parsed from html by UDTFs."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASE_URL = "https://example.com"


def matchup_url(url: Column, base: str = BASE_URL) -> Column:
    """The url's matchup page: absolute, path without trailing slashes and ending in /matchups, query and fragment kept."""
    u = F.trim(url)
    absolute = F.when(F.rlike(u, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]")), u).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(u, r"^/+", "")))
    part = lambda i: F.regexp_extract(absolute, r"^([^:/?#]+://[^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$", i)
    path = F.regexp_replace(part(2), r"/+$", "")
    tail = lambda i: F.when(F.length(part(i)) > 1, part(i)).otherwise(F.lit(""))
    return F.when(F.length(u) > 0, F.concat(part(1), F.when(F.endswith(path, F.lit("/matchups")), path).otherwise(F.concat(path, F.lit("/matchups"))), tail(3), tail(4)))


def cache_key(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)


def is_fresh(fetched_at: Column, now: Column, ttl_minutes: int) -> Column:
    if ttl_minutes <= 0:
        return F.lit(False)
    return F.coalesce(F.unix_micros(now.cast("timestamp")) - F.unix_micros(fetched_at.cast("timestamp")) < ttl_minutes * 60_000_000, F.lit(False))


def distinct_urls(pages: DataFrame, order: str) -> DataFrame:
    """Pages with a url, the first (by ``order``) of each."""
    first = Window.partitionBy(F.trim("url")).orderBy(order)
    return pages.where(F.length(F.trim("url")) > 0).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def with_cache(wanted: DataFrame, cache: DataFrame, now: Column, ttl_minutes: int) -> DataFrame:
    """``wanted`` (url) plus html and from_cache: the newest page of ``cache`` (cache_key, html, fetched_at) if it is fresh."""
    newest = cache.groupBy("cache_key").agg(F.max_by("html", "fetched_at").alias("html"), F.max("fetched_at").alias("fetched_at"))
    fresh = newest.where(is_fresh(F.col("fetched_at"), now, ttl_minutes)).select("cache_key", "html", F.lit(True).alias("from_cache"))
    keyed = wanted.withColumn("cache_key", cache_key(F.trim("url")))
    return keyed.join(fresh, "cache_key", "left").withColumn("from_cache", F.coalesce("from_cache", F.lit(False))).drop("cache_key")


def scan(wanted: DataFrame, order: str, cache: DataFrame, fetched: DataFrame, now: Column, ttl_minutes: int = 720) -> DataFrame:
    """``wanted`` (url), each url once, plus html and from_cache: from the cache if fresh, else from ``fetched`` (url, html),
    which an outside fetcher has filled for the misses; html stays null where neither has it."""
    new = fetched.select(F.trim("url").alias("_url"), F.col("html").alias("_html"))
    pages = with_cache(distinct_urls(wanted, order), cache, now, ttl_minutes)
    rows = pages.join(new, (F.trim("url") == F.col("_url")) & ~F.col("from_cache"), "left")
    return rows.withColumn("html", F.coalesce("html", "_html")).drop("_url", "_html")


def scan_counts(pages: DataFrame) -> DataFrame:
    """One row (total, cache_hits) of scanned pages."""
    return pages.agg(F.count("*").alias("total"), F.count_if("from_cache").alias("cache_hits"))


class Tables(HTMLParser):
    """All tables of a page: header texts, and rows of cells (text, text of the first link, its target)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open, self.cell, self.link = [], [], None, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"rows": [], "body": None, "head": []})
            self.tables.append(self.open[-1])
        elif self.open:
            table = self.open[-1]
            if tag == "thead":
                table["in_head"] = True
            elif tag == "tbody":
                table["in_head"] = False
                table["body"] = table["body"] if table["body"] is not None else len(table["rows"])
            elif tag == "tr":
                self.end_cell()
                table["rows"].append([])
            elif tag in ("td", "th"):
                self.end_cell()
                if not table["rows"]:
                    table["rows"].append([])
                self.cell = {"tag": tag, "text": [], "link": None, "href": None, "head": table.get("in_head", False)}
                table["rows"][-1].append(self.cell)
            elif tag == "a" and self.cell is not None and self.cell["link"] is None:
                self.cell["link"], self.cell["href"], self.link = [], dict(attrs).get("href"), self.cell

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = None
        elif tag in ("td", "th", "tr"):
            self.end_cell()
        elif tag == "thead" and self.open:
            self.open[-1]["in_head"] = False
        elif tag == "table" and self.open:
            self.end_cell()
            self.open.pop()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell["text"].append(data)
            if self.link is self.cell:
                self.cell["link"].append(data)

    def end_cell(self):
        self.cell = self.link = None


def said(parts) -> str:
    return " ".join(p.strip() for p in parts or () if p.strip())


def read_tables(html: str | None) -> list[dict]:
    """For each table: heads, and body rows of (text, link text, href)."""
    parser = Tables()
    parser.feed(html or "")
    out = []
    for t in parser.tables:
        rows = [r for r in t["rows"] if r]
        in_head = [c for r in rows for c in r if c["head"]]
        heads = [said(c["text"]) for c in (in_head or [c for r in rows for c in r if c["tag"] == "th"])]
        all_heads = [said(c["text"]) for r in rows for c in r if c["tag"] == "th"]
        body = t["rows"][t["body"]:] if t["body"] is not None else t["rows"][1:]
        out.append({"heads": heads, "all_heads": all_heads, "rows": [[(said(c["text"]), None if c["link"] is None else said(c["link"]), c["href"]) for c in r] for r in body if r], "tags": [[c["tag"] for c in r] for r in body if r]})
    return out


@F.udtf(returnType="opponent string, matches string, record string, rate string")
class MatchupRows:
    """The matchup table's rows as text: the table with deck, matches, score and win columns, else the first."""

    def eval(self, html: str):
        def place(heads, test):
            return next((i for i, h in enumerate(heads) if test(h.lower())), None)

        tests = [lambda h: "deck" in h, lambda h: "matches" in h, lambda h: "score" in h or "record" in h, lambda h: ("win" in h and "%" in h) or "winrate" in h]
        tables = read_tables(html)
        table = next((t for t in tables if all(place(t["all_heads"], x) is not None for x in tests)), tables[0] if tables else None)
        if table is None:
            return
        at = [place(table["heads"], x) for x in tests]
        if None in at:
            return
        for row in table["rows"]:
            if max(at) < len(row):
                opponent = row[at[0]]
                yield (opponent[1] if opponent[1] is not None else opponent[0]) or "Unknown", row[at[1]][0], row[at[2]][0], row[at[3]][0]


@F.udtf(returnType="pos int, rank string, deck string, share string, count string, url string")
class DecklistRows:
    """The usage table's rows: the first table with a deck column, else the first; columns found by name."""

    def eval(self, html: str):
        tables = read_tables(html)
        if not tables:
            raise ValueError("the page has no table")
        table = next((t for t in tables if any("deck" in h.lower() for h in t["all_heads"])), tables[0])
        heads = table["heads"]

        def place(exact, *tests):
            if exact in heads:
                return heads.index(exact)
            return next((i for i, h in enumerate(heads) if any(t(h.strip().lower()) for t in tests)), None)

        rank = place("Rank", lambda h: h in ("rank", "#", "pos", "position", "placement"))
        deck = place("Deck", lambda h: "deck" in h)
        if deck is None:
            raise ValueError("the table has no deck column")
        share, count = place("Share", lambda h: "share" in h or h == "%"), place("Count", lambda h: "count" in h or "players" in h)
        rows = [r for r, tags in zip(table["rows"], table["tags"], strict=True) if "td" in tags]
        if not rows:
            raise ValueError("the table is empty")
        for n, row in enumerate(rows, 1):
            cell = lambda i: row[i][0] if i is not None and i < len(row) else None  # noqa: B023, E731
            href = row[deck][2] if deck < len(row) else None
            yield n, str(n) if rank is None else cell(rank), cell(deck), cell(share), cell(count), None if not href else href if re.match("https?:", href) else f"{BASE_URL}/{href.lstrip('/')}"


def parse_matchups(pages: DataFrame) -> DataFrame:
    """(a, b, w, l, t, n, winrate) from pages (deck, html)."""
    rows = pages.select("deck", "html").alias("p").lateralJoin(MatchupRows(F.col("p.html").outer()).alias("r")).select(F.col("p.deck").alias("a"), "r.*")
    dash = "[\\-–—−]"
    record = lambda i: F.coalesce(F.regexp_extract("record", rf"(\d+)\s*{dash}\s*(\d+)(?:\s*{dash}\s*(\d+))?", i).try_cast("bigint"), F.lit(0))
    n = F.coalesce(F.regexp_replace("matches", r"\D", "").try_cast("bigint"), F.lit(0))
    rows = rows.withColumns({"w": record(1), "l": record(2), "t": record(3)}).withColumn("n", F.greatest(n, F.col("w") + F.col("l") + F.col("t")))
    rate = F.regexp_extract(F.replace("rate", F.lit(","), F.lit(".")), r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    whole = F.when(F.col("n") > 0, F.lit(100.0) * F.col("w") / F.greatest(F.col("n"), F.lit(1))).otherwise(F.lit(0.0))
    return rows.select("a", F.col("opponent").alias("b"), "w", "l", "t", "n", F.bround(F.coalesce(rate, whole), 2).alias("winrate"))


def parse_decklist(pages: DataFrame) -> DataFrame:
    """(rank, deck, share, count, url) from pages (html), by rank."""
    rows = pages.select("html").alias("p").lateralJoin(DecklistRows(F.col("p.html").outer()).alias("r")).select("r.*")
    return rows.select(F.rint(F.col("rank").try_cast("double")).cast("bigint").alias("rank"), "deck", "share", F.col("count").try_cast("bigint").alias("count"), "url").orderBy("rank")
