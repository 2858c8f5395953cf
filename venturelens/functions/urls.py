"""URL handling: resolve against a base, host tests, slugs and name candidates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venturelens import vocabulary as V

SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def host(url: Column) -> Column:
    """Host without a port, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def bare_host(url: Column) -> Column:
    return F.replace(host(url), F.lit("www."), F.lit(""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", 0)


def _without_dots(path_: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(F.substring(path_, F.lit(2), F.length(path_)), "/", -1)
    last = F.element_at(segments, -1)

    def step(acc: Column, s: Column) -> Column:
        return (
            F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s)))
        )

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    tail = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), tail)


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` as seen from ``base`` (RFC 3986 section 5.2)."""
    scheme = F.regexp_extract(base, SCHEME, 0)
    base_path = F.when(path(base) == "", F.lit("/")).otherwise(path(base))
    folder = F.regexp_extract(base_path, r"^.*/", 0)
    href_path = F.regexp_extract(href, r"^[^?#]*", 0)
    href_rest = F.substring(href, F.length(href_path) + 1, F.length(href))
    target = F.when(F.startswith(href, F.lit("/")), href_path).otherwise(F.concat(folder, href_path))
    clean = F.when(F.regexp_like(target, F.lit(r"/\.\.?(?:/|$)")), _without_dots(target)).otherwise(target)
    no_fragment = F.regexp_extract(base, r"^[^#]*", 0)
    no_query = F.regexp_extract(base, r"^[^?#]*", 0)
    return (
        F.when(href == "", base)
        .when(F.regexp_like(href, F.lit(SCHEME)), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .otherwise(F.concat(origin(base), clean, href_rest))
    )


def leaves_site(original: Column, final: Column) -> Column:
    """True where the final host is neither the original host nor a sub- or super-domain of it."""
    a, b = bare_host(original), bare_host(final)
    same = (a == b) | F.endswith(b, F.concat(F.lit("."), a)) | F.endswith(a, F.concat(F.lit("."), b))
    return (a != "") & (b != "") & ~same


def clean_profile_url(url: Column) -> Column:
    """Without query, fragment and trailing slashes."""
    return F.regexp_replace(F.substring_index(F.substring_index(url, "?", 1), "#", 1), "/+$", "")


def first_link(links: Column, needle: str) -> Column:
    """First href holding ``needle``; null if none does."""
    return F.get(F.filter(links, lambda x: F.contains(x, F.lit(needle))), 0)


def first_outside_link(links: Column, list_host: str = V.LIST_SITE_HOST) -> Column:
    """First absolute web link that is not on the list site."""
    return F.get(
        F.filter(
            links,
            lambda x: F.regexp_like(x, F.lit(r"(?i)^https?://")) & ~F.contains(F.lower(x), F.lit(list_host)),
        ),
        0,
    )


def squeezed_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), r"[ .]", "")


def website_candidates(name: Column, suffix: str = V.NAME_SUFFIX_PATTERN) -> Column:
    root = F.regexp_replace(F.regexp_replace(F.lower(name), suffix, ""), r"[ .]", "")
    return F.array(
        F.concat(F.lit("https://"), root, F.lit(".com")),
        F.concat(F.lit("https://"), root, F.lit(".ai")),
        F.concat(F.lit("https://"), root, F.lit(".io")),
        F.concat(F.lit("https://www."), root, F.lit(".com")),
    )


def network_candidates(name: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(name), r"\s+", "-"), r"[^\w-]", "")
    page = F.concat(F.lit("https://www.linkedin.com/company/"), slug)
    return F.array(page, F.concat(page, F.lit("-ai")), F.concat(page, F.lit("ai")))


def file_slug(name: Column) -> Column:
    """Lower case, blanks to ``_``, full stops dropped, ``&`` to ``and``."""
    s = F.replace(F.lower(name), F.lit(" "), F.lit("_"))
    return F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit("&"), F.lit("and"))


def folder_slug(name: Column) -> Column:
    """Lower case; blank, slash, backslash and full stop to ``_``."""
    return F.translate(F.lower(name), " /\\.", "____")


def display_name(folder: Column) -> Column:
    return F.initcap(F.replace(folder, F.lit("_"), F.lit(" ")))


def stable_id(*parts: Column) -> Column:
    """A repeatable identifier in UUID layout, so a retried task writes the same id."""
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts])


def repo_owner(url: Column, repo_host: str = V.REPO_HOST) -> Column:
    owner = F.get(F.split(F.regexp_replace(path(url), "^/+|/+$", ""), "/", -1), 0)
    return F.when(F.contains(host(url), F.lit(repo_host)) & (owner != ""), owner)


def repo_name(url: Column, repo_host: str = V.REPO_HOST) -> Column:
    """Second path part without a ``.git`` ending; empty for an owner-only URL, null if no owner."""
    second = F.get(F.split(F.regexp_replace(path(url), "^/+|/+$", ""), "/", -1), 1)
    return F.when(
        repo_owner(url, repo_host).isNotNull(),
        F.coalesce(F.regexp_replace(second, r"\.git$", ""), F.lit("")),
    )
