"""Records from HTML: a small tree over the standard library's tokenizer, and the page readers.

The tree nests as written: a tag closes only at its own end tag, so lenient
pages keep their text. Comments are left out of text; script and style are not.
The readers run once for each page in Arrow batches, after all filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeflow.schemas import ENRICHMENT, ERRORS, NOT_FOUND, PARSED, REVIEW

#: Elements without content (HTML standard).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

# Class names and headings of the captured pages.
SECTION, HEADING, ITEM_LIST, ITEM = "DAQTB", "fr6Pj", "xrrcZ", "zxtJF"
COPYRIGHT, MORE, MORE_LINK = "w8afO", "x4zu8", "place_bluelink"
REVIEW_LIST, REVIEW_ITEM = "_review_list", "place_apply_pui"
TITLES = ["진료과목별 전문의 정보", "진료과목", "특수진료장비", "우수기관 평가정보", "의료인 수", "주차"]
BY_DEPARTMENT = "진료과목별"  # a heading with it isn't that of the list of departments
MEDICAL_TITLE, REVIEW_TAB = "진료정보", "리뷰"
PAGE_SECTION, PAGE_HEADER, PAGE_TITLE, PAGE_CONTENT = "place_section", "place_section_header", "place_section_header_title", "place_section_content"
PAGING = "zRM9F"
VISIT_DATE, VISIT_COUNT, VERIFIED = "방문일", "번째 방문", "인증"


class Node:
    """An element; children are nodes and strings."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        """Descendants in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def all(self, tag: str | tuple | None = None, cls: str | None = None, **attrs: str) -> list[Node]:
        tags = (tag,) if isinstance(tag, str) else tag
        return [
            n for n in self.walk()
            if (tags is None or n.tag in tags) and (cls is None or cls in (n.attrs.get("class") or "").split()) and all(n.attrs.get(k.replace("_", "-")) == v for k, v in attrs.items())
        ]

    def find(self, tag: str | tuple | None = None, cls: str | None = None, **attrs: str) -> Node | None:
        return next(iter(self.all(tag, cls, **attrs)), None)

    def strings(self) -> Iterator[str]:
        stack = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                yield c
            else:
                stack.extend(reversed(c.children))

    def text(self, sep: str = "") -> str:
        """Stripped text pieces, joined."""
        return sep.join(s for s in (x.strip() for x in self.strings()) if s)

    def shown(self, tag: str) -> Iterator[Node]:
        """Descendants of one tag that aren't hidden, nor in a hidden element."""
        for c in self.children:
            if isinstance(c, Node) and not c.hidden():
                if c.tag == tag:
                    yield c
                yield from c.shown(tag)

    def hidden(self) -> bool:
        style = "".join((self.attrs.get("style") or "").split()).lower()
        return "hidden" in self.attrs or "display:none" in style or "visibility:hidden" in style

    def inner(self) -> str:
        """The children as HTML."""
        out, todo = [], list(reversed(self.children))
        raw = self.tag in ("script", "style")
        while todo:
            c = todo.pop()
            if isinstance(c, tuple):  # an end tag that was put off
                out.append(c[0])
            elif isinstance(c, str):
                out.append(c if raw else escape(c, quote=False))
            else:
                out.append(c.begin())
                if c.tag in ("script", "style"):
                    out.append("".join(x for x in c.children if isinstance(x, str)) + f"</{c.tag}>")
                elif c.tag not in VOID:
                    todo.append((f"</{c.tag}>",))
                    todo.extend(reversed(c.children))
        return "".join(out)

    def begin(self) -> str:
        return f"<{self.tag}{''.join(f' {k}="{escape(v or "")}"' for k, v in self.attrs.items())}>"

    def outer(self) -> str:
        return self.begin() + ("" if self.tag in VOID else f"{self.inner()}</{self.tag}>")


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        n = Node(tag, dict(attrs))
        self.open[-1].children.append(n)
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def table_rows(table: Node | None, key: str, value: str) -> list[dict] | None:
    """First two cells of each row of a table with a tbody; rows with fewer are skipped."""
    body = table.find("tbody") if table else None
    if body is None:
        return None
    out = []
    for row in body.all("tr"):
        cells = row.all(("th", "td"))
        if len(cells) >= 2:
            out.append({key: cells[0].text(), value: cells[1].text()})
    return out or None


def list_items(ul: Node | None) -> list[str] | None:
    """Texts of the items of the known class, without empty ones."""
    return [t for t in (li.text() for li in ul.all("li", ITEM)) if t] or None if ul else None


def medical_info(html: str) -> dict:
    """Sections by their heading, the first matching title deciding; a later section of the same kind overwrites."""
    root, out = parse(html), {}
    tables = {
        0: ("specialist_by_department", "department", "specialist_count"),
        2: ("special_equipment", "equipment_name", "count"),
        3: ("excellent_institution_evaluation", "evaluation_item", "evaluation_info"),
        4: ("medical_staff_count", "staff_type", "count"),
    }
    for section in root.all("div", SECTION):
        heading = section.find("h3", HEADING)
        if heading is None:
            continue
        title = heading.text()
        kind = next((i for i, t in enumerate(TITLES) if t in title and not (i == 1 and BY_DEPARTMENT in title)), None)
        if kind in tables:
            name, key, value = tables[kind]
            found = {name: table_rows(section.find("table"), key, value)}
        elif kind == 1:
            found = {"medical_departments": list_items(section.find("ul", ITEM_LIST))}
        elif kind == 5:
            ul = section.find("ul")
            found = {"parking": list_items(ul)} if ul else {"parking_text": section.text().replace(title, "").strip() or None}
        else:
            continue
        out |= {k: v for k, v in found.items() if v}
    if (foot := root.find("div", COPYRIGHT)) is not None and foot.text():
        out["copyright_info"] = foot.text()
    more = root.find("div", MORE)
    if more is not None and (link := more.find("a", MORE_LINK)) is not None:
        out["more_info_link"], out["more_info_text"] = link.attrs.get("href") or None, link.text() or None
    return out


def medical_section(html: str) -> tuple[str | None, bool]:
    """HTML inside the content of the first page section whose title names medical information (null without one), and whether a header names it at all."""
    root = parse(html)
    for section in root.all("div", PAGE_SECTION):
        head = section.find("h2", PAGE_HEADER)
        title = head.find("div", PAGE_TITLE) if head else None
        content = section.find("div", PAGE_CONTENT)
        if title is not None and content is not None and MEDICAL_TITLE in title.text():
            return content.inner() or None, True
    heads = (h for section in root.all("div", PAGE_SECTION) for h in section.all("h2", PAGE_HEADER))
    return None, any(MEDICAL_TITLE in d.text() for h in heads for d in h.all("div"))


def enrichment(html: str) -> dict:
    """What a page tells of medical information: flag, section HTML, parsed fields and whether there are any, or the text of the failure."""
    out = {"has_medical_info": False, "medical_info_raw": None, "medical_info_parsed": None, "parsing_success": False, "enrichment_error": None}
    if not html.strip():
        return out | {"enrichment_error": ERRORS["timeout"]}
    raw, named = medical_section(html)
    if raw is None:
        return out | {"enrichment_error": ERRORS["html" if named else "section"]}
    parsed = medical_info(raw)
    return out | {"has_medical_info": True, "medical_info_raw": raw, "medical_info_parsed": parsed or None, "parsing_success": bool(parsed)}


def review_page(html: str) -> dict:
    """What a page tells of reviews: the list's HTML and its reviews, or the text of the failure."""
    out = {"reviews": [], "review_html": None, "scrape_error": None}
    if not html.strip():
        return out | {"scrape_error": ERRORS["timeout"]}
    root = parse(html)
    found = root.find(id=REVIEW_LIST)
    if found is None:
        tab = any(REVIEW_TAB in a.text() for a in root.all("a", role="tab"))
        return out | {"scrape_error": ERRORS["list" if tab else "tab"]}
    whole = found.outer()
    return out | {"reviews": reviews(whole), "review_html": whole}


def more_pages(page: str | Node) -> bool:
    """False if the last paging button of a search page is disabled."""
    root = parse(page) if isinstance(page, str) else page
    buttons = [a for box in root.all("div", PAGING) for a in box.all("a", target="_self")]
    return not buttons or buttons[-1].attrs.get("aria-disabled") != "true"


def review(item: Node) -> dict:
    name, profile = item.find("span", "pui__NMi-Dp"), item.find("a", data_pui_click_code="profile")
    body = item.find("div", "pui__vn15t2")
    more = body.find("a", data_pui_click_code="rvshowmore") if body else None
    visit: dict = {}
    for span in item.all("span", "pui__gfuUIT"):
        whole = span.text()
        if VISIT_DATE in "".join(span.strings()) or any(VISIT_DATE in str(v) for n in span.walk() for v in n.attrs.values()):
            time = span.find("time")
            if time is not None:
                visit["visit_date"] = time.text()
        elif VISIT_COUNT in whole:
            visit["visit_count"] = whole
        elif VERIFIED in whole:
            visit["verification_method"] = whole
    photos = item.find("div", "lazyload-wrapper")
    images = [s for s in (i.attrs.get("src") for i in photos.all("img")) if s and not s.startswith("data:image")] if photos else []
    reacted = item.find("div", "pui__l8k0-f")
    count = reacted.find("em", "pui__x-pa-u") if reacted else None
    return {
        "reviewer_info": {"reviewer_name": name.text() if name else None, "reviewer_stats": [s.text() for s in item.all("span", "pui__WN-kAf")], "profile_url": profile.attrs.get("href") if profile else None},
        "review_text": more.text("\n") if more else "",
        "visit_info": visit,
        "visit_keywords": [t for t in (s.text() for s in item.all("span", "pui__V8F9nN")) if t],
        "images": images,
        "owner_response": owner_response(item),
        "reactions": {"reaction_count": count.text() if count else None},
    }


def owner_response(item: Node) -> dict | None:
    box = item.find("div", "pui__GbW8H7")
    if box is None:
        return None
    name, when, body = box.find("span", "pui__XE54q7"), box.find("span", "pui__4APmFd"), box.find("div", "pui__J0tczd")
    time = when.find("time") if when else None
    said = (body.find(("a", "span"), data_pui_click_code="text") or body).text("\n") if body else None
    return {"owner_name": name.text() if name else None, "response_date": time.text() if time else None, "response_text": said}


def reviews(html: str) -> list[dict]:
    """Reviews with their place in the list, from 1; one that can't be read leaves a gap."""
    found = parse(html).find("ul", id=REVIEW_LIST)
    out = []
    for i, item in enumerate(found.all("li", REVIEW_ITEM) if found else [], 1):
        try:
            out.append(review(item) | {"review_index": i})
        except (AttributeError, KeyError, ValueError):
            continue
    return out


def facility(html: str) -> dict:
    """Detail fields of a place page; what isn't there is the not-found text, hours are null without any."""
    root = parse(html)
    first = lambda tag, cls: (n.text() if (n := root.find(tag, cls)) else "") or NOT_FOUND
    hours = []
    for row in root.all("div", "w9QyJ"):
        day, time = row.find("span", "i8cJw"), row.find("div", "H3ua4")
        if day and time:
            hours.append(f"{day.text()}: {time.text()}")
    status = next((e.text() for row in root.all("div", "w9QyJ") if (e := row.find("em"))), "")
    site = root.find("a", "CHmqa")
    return {
        "name": first("span", "GHAhO"), "category": first("span", "lnJFt"), "reviews": ", ".join(t for t in (s.text() for s in root.all("span", "PXMot")) if t) or NOT_FOUND,
        "address": first("span", "LDgIH"), "phone": first("span", "xlx7Q"), "hours_status": status or NOT_FOUND, "business_hours": "; ".join(hours) or None,
        "amenities": first("div", "xPvPE"), "website": (site.attrs.get("href") if site else None) or NOT_FOUND,
    }


def search_items(page: str | Node) -> list[dict]:
    """Name and link of each list item with text or a link: the first name that isn't empty, else the first line, else 'Unknown'."""
    out = []
    for li in (parse(page) if isinstance(page, str) else page).all("li"):
        if not li.text() and li.find("a") is None:
            continue
        places = [li.find("span", "TYaxT"), next((n for p in li.all("span", "place_bluelink") for n in p.all("span")), None)]
        places += [next((n for p in li.all(tag) for n in p.all("span")), None) for tag in ("a", "div")]
        name = next((t for t in (n.text() for n in places if n is not None) if t), None) or li.text("\n").split("\n")[0] or "Unknown"
        out.append({"name": name, "href": clickable(li)})
    return out


def clickable(li: Node) -> str | None:
    """href of the main link among those that are displayed: by the two known classes, then any link with an address."""
    links = list(li.shown("a"))
    by = lambda cls: (a for a in links if cls in (a.attrs.get("class") or "").split())
    link = next((a for some in (by("tzwk0"), by("place_bluelink"), (a for a in links if a.attrs.get("href"))) for a in some), None)
    return link.attrs.get("href") if link else None


def frame_structure(entry: Column, search: Column) -> Column:
    """'single', 'dual' or 'none' from whether a page has the entry frame and the search frame."""
    return F.when(entry & search, F.lit("dual")).when(entry, F.lit("single")).otherwise(F.lit("none"))


def _reader(read: Callable[[str], object], kind: T.DataType, column: Column | str) -> Column:
    """value and error of each page; a page that can't be read is an error text, never an exception."""
    out = T.StructType([T.StructField("value", kind), T.StructField("error", T.StringType())])

    @F.pandas_udf(out)
    def apply(pages: pd.Series) -> pd.DataFrame:
        values, errors = [], []
        for page in pages:
            try:
                values.append(None if page is None else read(page))
                errors.append(None)
            except Exception as e:  # noqa: BLE001  errors are data here
                values.append(None)
                errors.append(str(e) or type(e).__name__)
        return pd.DataFrame({"value": values, "error": errors})

    return apply(column)


def _shaped(value: object, kind: T.DataType) -> object:
    """The value with every declared field."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _shaped(value.get(f.name), f.dataType) for f in kind}
    if isinstance(kind, T.ArrayType):
        return [_shaped(v, kind.elementType) for v in value]
    return value


def read_medical_info(column: Column | str) -> Column:
    return _reader(lambda h: _shaped(medical_info(h), PARSED), PARSED, column)


def read_enrichment(column: Column | str) -> Column:
    kind = T.StructType([f for f in ENRICHMENT if f.name not in ("enriched_at", "verified_place_id")])
    return _reader(lambda h: _shaped(enrichment(h), kind), kind, column)


def read_review_page(column: Column | str) -> Column:
    kind = T.StructType([T.StructField("reviews", T.ArrayType(REVIEW)), T.StructField("review_html", T.StringType()), T.StructField("scrape_error", T.StringType())])
    return _reader(lambda h: _shaped(review_page(h), kind), kind, column)


def read_reviews(column: Column | str) -> Column:
    kind = T.ArrayType(REVIEW)
    return _reader(lambda h: _shaped(reviews(h), kind), kind, column)


def read_facility(column: Column | str) -> Column:
    kind = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "category", "reviews", "address", "phone", "hours_status", "business_hours", "amenities", "website")])
    return _reader(lambda h: _shaped(facility(h), kind), kind, column)


def read_search_page(column: Column | str) -> Column:
    """The list items of a search page, and whether there are more pages; parsed once."""
    item = T.StructType([T.StructField("name", T.StringType()), T.StructField("href", T.StringType())])
    kind = T.StructType([T.StructField("items", T.ArrayType(item)), T.StructField("more", T.BooleanType())])

    def read(page: str) -> dict:
        root = parse(page)
        return {"items": search_items(root), "more": more_pages(root)}

    return _reader(read, kind, column)


def read_texts(column: Column | str, tag: str) -> Column:
    """Texts of the elements of one tag, without empty ones."""
    return _reader(lambda h: [t for t in (n.text() for n in parse(h).all(tag)) if t], T.ArrayType(T.StringType()), column)


def read_links(column: Column | str, within: str | None = None) -> Column:
    """href of the links (inside elements of one tag)."""

    def links(h: str) -> list[str]:
        root = parse(h)
        inside = [root] if within is None else root.all(within)[:1]
        return [a.attrs["href"] for n in inside for a in n.all("a") if a.attrs.get("href") is not None]

    return _reader(links, T.ArrayType(T.StringType()), column)
