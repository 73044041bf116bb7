"""Links, images and URLs of HTML pages, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions of images.
EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp", ".tif", ".tiff"]
SITE = "https://commons.wikimedia.org"
CDN = "upload.wikimedia.org"

_TAG = r"(?i)<{}\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"


def tags(html: Column, name: str) -> Column:
    """Start tags of one kind, as text."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TAG.format(name)), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value with the five predefined entities resolved; absent: empty."""
    quoted = F.regexp_extract(tag, rf"(?i)\s{name}\s*=\s*\"([^\"]*)\"", 1)
    single = F.regexp_extract(tag, rf"(?i)\s{name}\s*=\s*'([^']*)'", 1)
    value = F.when(quoted != "", quoted).otherwise(single)
    for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def unquote(value: Column) -> Column:
    """Percent-decoding that leaves "+" alone; an invalid escape leaves all as it is."""
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def quote(value: Column, safe: str = "") -> Column:
    """Percent-encoding of UTF-8, blanks as %20; safe characters stay."""
    out = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    out = F.replace(F.replace(out, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    for c in safe:
        if c not in "_-.~":
            out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return out


def has_image_extension(name: Column) -> Column:
    low = F.lower(name)
    out = F.lit(False)
    for e in EXTENSIONS:
        out = out | F.endswith(low, F.lit(e))
    return out


def file_links(html: Column, prefix: str = "/wiki/File:", images_only: bool = True) -> Column:
    """Distinct decoded names that links below a prefix point to."""
    hrefs = F.transform(tags(html, "a"), lambda t: attribute(t, "href"))
    below = F.filter(hrefs, lambda h: F.startswith(h, F.lit(prefix)))
    cut = F.transform(below, lambda h: F.substring_index(F.substring(h, len(prefix) + 1, 1 << 30), "#", 1))
    names = F.transform(cut, lambda n: F.btrim(F.replace(unquote(n), F.lit("_"), F.lit(" "))))
    return F.array_distinct(F.filter(names, has_image_extension) if images_only else names)


def absolute(url: Column, site: str = SITE) -> Column:
    return F.when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url)).when(F.startswith(url, F.lit("/")), F.concat(F.lit(site), url)).otherwise(url)


def next_pages(html: Column, site: str = SITE) -> Column:
    """Distinct continuation links: a pagefrom link to a category, or a title "next page"."""
    both = F.transform(tags(html, "a"), lambda t: F.struct(attribute(t, "href").alias("href"), F.lower(attribute(t, "title")).alias("title")))

    def goes_on(a: Column) -> Column:
        listed = F.contains(a["href"], F.lit("pagefrom=")) & F.contains(a["href"], F.lit("/wiki/Category:"))
        return listed | (F.startswith(a["title"], F.lit("next page")) & (a["href"] != ""))

    return F.array_distinct(F.transform(F.filter(both, goes_on), lambda a: absolute(a["href"], site)))


def image_url(value: Column, rule: str = "published", site: str = SITE, cdn: str = CDN) -> Column:
    """An image URL by rule, null if it is none of the CDN's thumbnails.

    "published" keeps it; "enlarged" asks for 1024 pixels; "original" leads to the file the
    thumbnail was made from and needs four path parts below the thumbnails.
    """
    url = absolute(F.substring_index(F.btrim(value), " ", 1), site)
    if rule == "original":
        marker = "/wikipedia/commons/thumb/"
        rest = F.split(F.substring_index(url, marker, -1), "/")
        path = F.array_join(F.slice(rest, 1, F.greatest(F.size(rest) - 1, F.lit(0))), "/")
        made = F.concat(F.substring_index(url, marker, 1), F.lit("/wikipedia/commons/"), path)
        fits = F.contains(url, F.lit(cdn)) & F.contains(url, F.lit(marker)) & (F.size(rest) >= 4)
        return F.when(fits & has_image_extension(F.substring_index(made, "?", 1)), made)
    fits = F.contains(url, F.lit(cdn)) & F.contains(url, F.lit("/thumb/")) & has_image_extension(F.substring_index(url, "?", 1))
    return F.when(fits, F.regexp_replace(url, r"/\d+px-([^/]+)$", "/1024px-$1") if rule == "enlarged" else url)


def images(html: Column, rule: str = "published") -> Column:
    """Distinct image URLs: of each <img> the last usable srcset option, else its src."""

    def one(tag: Column) -> Column:
        options = F.filter(F.transform(F.split(attribute(tag, "srcset"), ","), F.btrim), lambda o: o != "")
        usable = F.filter(F.transform(F.reverse(options), lambda o: image_url(o, rule)), F.isnotnull)
        return F.coalesce(F.get(usable, F.lit(0)), image_url(attribute(tag, "src"), rule))

    return F.array_distinct(F.filter(F.transform(tags(html, "img"), one), F.isnotnull))


def category_url(name: Column, site: str = SITE) -> Column:
    return F.concat(F.lit(f"{site}/wiki/"), quote(F.concat(F.lit("Category:"), F.replace(name, F.lit(" "), F.lit("_"))), ":_()-"))


def file_page_url(name: Column, site: str = SITE) -> Column:
    return F.concat(F.lit(f"{site}/wiki/"), quote(F.concat(F.lit("File:"), F.replace(name, F.lit(" "), F.lit("_"))), ":_()-"))


def file_image_url(name: Column, width: int = 1200, site: str = SITE) -> Column:
    return F.concat(F.lit(f"{site}/wiki/Special:Redirect/file/"), quote(F.replace(name, F.lit(" "), F.lit("_"))), F.lit(f"?width={width}"))
