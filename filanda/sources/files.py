"""Folders as tables of files, by path predicates that the scan can push down."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders that hold no sources.
SKIPPED_FOLDERS = (".git", "node_modules", "_intermediate", "__pycache__")


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("docx", "txt", "md"), content: bool = True) -> DataFrame:
    """``path, rel, modified, n_bytes`` and ``content``: files below ``root`` with one of the suffixes, in any case.

    Office lock files (``~$``) and everything below a skipped folder, in any case, are left out. Without ``content`` no file is read.
    """
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.rstrip("/") + "/"
    rel = F.regexp_replace(F.regexp_replace("path", r"^file:/*", "/"), "^" + "".join(c if c.isalnum() or c in "/_-" else f"\\{c}" for c in base), "")
    out = f.select("path", rel.alias("rel"), F.col("modificationTime").alias("modified"), F.col("length").alias("n_bytes"),
        *(["content"] if content else []))
    low = F.lower("rel")
    name = F.element_at(F.split("rel", "/"), -1)
    skip = "(^|/)(" + "|".join(x.replace(".", r"\.") for x in SKIPPED_FOLDERS) + ")/"
    return out.where(low.rlike(r"\.(" + "|".join(suffixes) + ")$") & ~name.startswith("~$") & ~low.rlike(skip))


def decoded(content: Column | str) -> Column:
    """Text of a file: malformed UTF-8 becomes U+FFFD, a byte order mark goes, line ends are ``\\n``."""
    c = F.col(content) if isinstance(content, str) else content
    return F.regexp_replace(F.regexp_replace(F.make_valid_utf8(c.cast("string")), "^﻿", ""), "\r\n?", "\n")


def read_texts(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("txt", "md")) -> DataFrame:
    """``rel, text, has_bom, crlf, file_hash`` of text files."""
    f = list_files(spark, root, suffixes)
    raw = F.make_valid_utf8(F.col("content").cast("string"))
    return f.select("rel", decoded("content").alias("text"), raw.startswith("﻿").alias("has_bom"), F.contains(raw, F.lit("\r\n")).alias("crlf"),
        F.sha2("content", 256).alias("file_hash"))


def bucketed(files: DataFrame, sensitive: str = r"(?i)password|credenzial|secret",
    keys: tuple[str, ...] = ("pem", "key", "pfx", "kdbx", "p12")) -> DataFrame:
    """``files`` with ``bucket``: ``key-material`` by suffix, ``sensitive-name`` by file name, else ``ok``."""
    suffix = F.lower(F.regexp_extract("rel", r"\.([A-Za-z0-9]+)$", 1))
    return files.withColumn("bucket", F.when(suffix.isin(*keys), "key-material").when(F.element_at(F.split("rel", "/"), -1).rlike(sensitive),
        "sensitive-name").otherwise("ok"))


def excluded(files: DataFrame, rules: DataFrame) -> DataFrame:
    """``files`` without those that a rule ``path`` names, or, ending in ``/``, holds; by equi-join on every folder of a file."""
    parts = F.split("rel", "/")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"),
        F.when(i < F.size(parts), F.lit("/")).otherwise(F.lit(""))))
    hit = files.select("rel", F.explode(heads).alias("path")).join(rules.select("path"), "path").select("rel")
    return files.join(hit, "rel", "left_anti")


def import_closure(files: DataFrame, hops: int = 4) -> DataFrame:
    """``root, rel``: files reached from each file over lines ``@other.md`` outside code, in at most ``hops`` steps."""
    prose = F.regexp_replace("text", r"(?s)```.*?(?:```|\z)|`[^`\n]*`", "")
    links = files.select("rel", F.explode(F.regexp_extract_all(prose, F.lit(r"(?m)(?:^|\s)@([\w./-]+\.md)"), F.lit(1))).alias("to")).distinct()
    seen = links.select(F.col("rel").alias("root"), F.col("to").alias("rel"))
    for _ in range(hops - 1):
        seen = seen.unionByName(seen.join(links, "rel").select("root", F.col("to").alias("rel"))).distinct()
    return seen.join(files.select("rel"), "rel", "left_semi").select("root", "rel")


def restored(text: Column | str, has_bom: Column | str, crlf: Column | str) -> Column:
    """The text as its file had it: with its byte order mark and its line ends; the inverse of ``decoded`` for files of one kind of line end."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    body = F.when(c(crlf), F.replace(c(text), F.lit("\n"), F.lit("\r\n"))).otherwise(c(text))
    return F.concat(F.when(c(has_bom), "\ufeff").otherwise(""), body)


def glob_pattern(glob: str) -> str:
    """The pattern of a glob: ``**`` any folders, ``*`` and ``?`` within one; everything else stands for itself."""
    said = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "^" + "".join(said.get(x, re.escape(x)) for x in re.split(r"(\*\*/|\*\*|\*|\?)", glob)) + "$"


def matching(files: DataFrame, globs: list[str]) -> DataFrame:
    """``files`` whose ``rel`` one of the globs matches, each once; none for an empty list."""
    hit = F.lit(False)
    for g in globs:
        hit = hit | F.col("rel").rlike(glob_pattern(g))
    return files.where(hit)


def without_marked(files: DataFrame, marker: str = ".md-unwrap-ignore") -> DataFrame:
    """``files`` outside every folder that holds a file called ``marker``, at any depth; by equi-join on the folders of a file."""
    folder = F.regexp_extract("rel", r"^(.*/)?[^/]*$", 1)
    marked = files.where(F.element_at(F.split("rel", "/"), -1) == marker).select(folder.alias("folder")).distinct()
    parts = F.split("rel", "/")
    folders = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.when(i == 0,
        F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))))
    hit = files.select("rel", F.explode(folders).alias("folder")).join(marked, "folder").select("rel")
    return files.join(hit, "rel", "left_anti")


def exclusion_rules(lines: DataFrame) -> DataFrame:
    """``line_no, path, reason, subtree, error`` from lines ``path # reason``. ``lines``: ``line_no, line``.

    Blank lines and those that begin with ``##`` are comments. A rule without reason has the error ``no-reason``, one without path
    ``no-path``; ``subtree`` is a path that ends in ``/``.
    """
    l = lines.withColumn("l", F.trim("line")).where("l <> '' and not startswith(l, '##')")
    path, reason = F.trim(F.regexp_extract("l", r"^([^#]*)", 1)), F.trim(F.regexp_extract("l", r"^[^#]*#(.*)$", 1))
    return l.select("line_no", path.alias("path"), reason.alias("reason"), path.endswith("/").alias("subtree"),
        F.when(path == "", "no-path").when(reason == "", "no-reason").alias("error"))


# Suffixes of files that hold no text to read.
NO_TEXT = "png jpg jpeg gif svg webp pdf zip mp4 mp3".split()


def source_texts(nodes: DataFrame, files: DataFrame) -> DataFrame:
    """``nodes`` with ``text`` of their ``source_file``: null for a blank path, a file that is not there, and one of ``NO_TEXT``.
    ``files``: ``rel, content``."""
    suffix = F.lower(F.regexp_extract("source_file", r"\.([A-Za-z0-9]+)$", 1))
    readable = F.when((F.trim("source_file") != "") & ~suffix.isin(*NO_TEXT), F.col("source_file"))
    texts = files.select(F.col("rel").alias("_rel"), decoded("content").alias("text"))
    return nodes.withColumn("_key", readable).join(texts, F.col("_key") == F.col("_rel"), "left").drop("_key", "_rel")
