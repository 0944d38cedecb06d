"""Links, globs and the object-store to HTTPS rewrite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The scheme that is rewritten and the file-system class named in reference files.
S3 = "s3://"
HTTPS = "https://"
S3_CLASS = "S3FileSystem"
HTTPS_CLASS = "HTTPFileSystem"


def provider(url: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Name of the first rule whose text occurs anywhere in the URL, case-sensitively."""
    found = F.lit(default)
    for text, name in reversed(rules):
        found = F.when(F.contains(url, F.lit(text)), F.lit(name)).otherwise(found)
    return F.when(url.isNotNull(), found)


def link(links: Column, access: str, strict: bool = True) -> Column:
    """URL of the first link of one access kind. Without one: an error, or NULL if not strict."""
    url = F.get(F.filter(links, lambda one: one["access"] == access), F.lit(0))["url"]
    if not strict:
        return url
    return F.coalesce(url, F.raise_error(F.lit(f"no {access} link")).cast("string"))


def basename(url: Column) -> Column:
    return F.regexp_extract(url, r"([^/]+)/*$", 1)


def glob_match(name: Column, glob: Column | str) -> Column:
    """``*`` stands for any text and ``?`` for one character; all else is literal."""
    if isinstance(glob, str):
        pattern = glob
        for special in ("\\", "%", "_"):
            pattern = pattern.replace(special, "\\" + special)
        return name.like(pattern.replace("*", "%").replace("?", "_"))
    pattern = glob
    for special in ("\\", "%", "_"):
        pattern = F.replace(pattern, F.lit(special), F.lit("\\" + special))
    pattern = F.replace(F.replace(pattern, F.lit("*"), F.lit("%")), F.lit("?"), F.lit("_"))
    return F.like(name, pattern)


def glob_parts(glob: Column) -> dict[str, Column]:
    """What a glob says of the beginning and the end of a name.

    ``_shape`` has an ``x`` for each literal character before the first and after the last star, with
    the ``?`` and one star as they are; ``_fixed`` has the characters themselves. ``_open`` is whether
    there is more between two stars. If not, a glob matches the names of which ``fixed_characters`` for
    its shape are its own.
    """
    star = F.contains(glob, F.lit("*"))
    head = F.substring_index(glob, "*", 1)
    tail = F.when(star, F.concat(F.lit("*"), F.substring_index(glob, "*", -1))).otherwise("")
    fixed = F.concat(head, tail)
    return {"_shape": F.regexp_replace(fixed, r"(?s)[^?*]", "x"), "_fixed": fixed,
            "_open": F.replace(F.regexp_extract(glob, r"(?s)\*(.*)\*", 1), F.lit("*"), F.lit("")) != ""}


def fixed_characters(name: Column, shape: Column) -> Column:
    """The characters of a name that a shape of ``glob_parts`` asks for; NULL for a name too short, or too long."""
    def seen(text: Column, mask: Column) -> Column:
        masked = F.array_join(F.zip_with(F.split(text, ""), F.split(mask, ""), lambda c, m: F.when(
            m == "?", "?").otherwise(c)), "")
        return F.when(F.contains(mask, F.lit("?")), masked).otherwise(text)

    star = F.contains(shape, F.lit("*"))
    head = F.substring_index(shape, "*", 1)
    tail = F.when(star, F.substring_index(shape, "*", -1)).otherwise("")
    n, first, last = F.char_length(name), F.char_length(head), F.char_length(tail)
    begin = seen(F.substring(name, F.lit(1), first), head)
    end = seen(F.substring(name, n - last + 1, last), tail)
    return F.when(star & (n >= first + last), F.concat(begin, F.lit("*"), end)).when(~star & (n == first), begin)


def without_scheme(url: Column) -> Column:
    """Every ``s3://`` removed, not only the leading one."""
    return F.replace(url, F.lit(S3), F.lit(""))


def bucket_of(url: Column) -> Column:
    return F.split_part(without_scheme(url), F.lit("/"), F.lit(1))


def https_url(url: Column, host: Column) -> Column:
    """HTTPS form of ``url`` on ``host``; URLs of another scheme stay as they are."""
    return F.when(url.startswith(S3), F.concat(F.lit(HTTPS), host, F.lit("/"), without_scheme(url))
                  ).otherwise(url)


def s3_to_https(url: Column, hosts: Mapping[str, str], default_host: str) -> Column:
    """As ``https_url``, with the host looked up by bucket in a literal map."""
    host = F.lit(default_host)
    if hosts:
        pairs = [F.lit(text) for item in hosts.items() for text in item]
        host = F.coalesce(F.try_element_at(F.create_map(*pairs), bucket_of(url)), host)
    return https_url(url, host)


def rewrite_text(text: Column, buckets: Sequence[str], hosts: Mapping[str, str],
                 default_host: str) -> Column:
    """Rewrite the class name, then each bucket in the order given.

    Every bucket sees the text as the one before left it: ``s3://bucket/`` becomes the HTTPS prefix,
    and a bare bucket name does too as long as the text has no ``https://`` in it.
    """
    out = F.replace(text, F.lit(S3_CLASS), F.lit(HTTPS_CLASS))
    for bucket in buckets:
        target = f"{HTTPS}{hosts.get(bucket, default_host)}/{bucket}"
        out = F.replace(out, F.lit(f"{S3}{bucket}/"), F.lit(f"{target}/"))
        bare = F.contains(out, F.lit(bucket)) & ~F.contains(out, F.lit(HTTPS))
        out = F.when(bare, F.replace(out, F.lit(bucket), F.lit(target))).otherwise(out)
    return out
