"""Prompts, answers and pages: what is asked for each topic, what came back, and the page made of it."""

from __future__ import annotations

import fnmatch
import os
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import text as X
from strataframe.tables import squeezed

# Sentences of which the offline answers are made.
SENTENCES = (
    "本节内容综合多份资料整理。",
    "其设计思路在工程实践中已被多次验证。",
    "关键参数与边界条件已在原始文档中记录。",
    "实现细节遵循团队既定的硬度约束。",
    "测试覆盖率与性能基线均满足验收要求。",
    "已知限制将在后续迭代中逐步解除。",
    "该模块与相邻系统的接口契约保持稳定。",
    "异常路径在多次回归中得到了充分覆盖。",
    "升级路径不会破坏既有部署的兼容性。",
    "配置项保留了清晰的迁移说明。",
    "权限与审计字段全部按照规范填充。",
    "可观测性指标接入到了统一的监控面板。",
    "上下游服务的限流策略经过实测调优。",
    "数据一致性靠幂等键 + 事务日志双重保证。",
    "构建产物的 SHA-256 与发布记录逐 byte 对齐。",
    "灰度发布过程中未发现新增的故障类型。",
)
EVIDENCE_SCAN = 49  # offline answers look for [1] to [49]
DEFAULT_HOW, DEFAULT_SAMPLE, DEFAULT_DOC = "Not explicitly defined", "Not specified", "Not explicitly stated"
UNCATEGORIZED = "_uncategorized"
QUOTED = r"[:#\[\]{}\",&*!|>%@`]"


def offline_answer(messages: Column, seed: int = 0) -> Column:
    """An answer without any model: two paragraphs of four fixed sentences each, chosen by the hash of
    the seed and the messages, with pins on the evidence that the user's messages number."""
    user = F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "user"), lambda m: m["content"]), "\n")
    numbers = F.filter(F.transform(F.regexp_extract_all(user, F.lit(r"\[([1-9][0-9]?)\]"), F.lit(1)), lambda x: x.cast("int")), lambda n: n <= EVIDENCE_SCAN)
    n = F.coalesce(F.array_max(numbers), F.lit(1))
    digest = F.sha2(F.concat(F.unhex(F.lit(f"{seed:016x}")), F.encode(X.prompt_text(messages), "UTF-8")), 256)
    pool = F.array(*map(F.lit, SENTENCES))
    # each sentence is the remainder by 16 of four bytes, which is their last hex digit
    pick = [F.element_at(pool, (F.conv(F.substring(digest, 8 * i + 8, 1), 16, 10).cast("int") + 1)) for i in range(8)]
    two = F.least(F.lit(2), n)

    def pins(paragraph: int) -> Column:
        first = (two * paragraph) % n
        return F.array_join(F.transform(F.sequence(F.lit(0), two - 1), lambda k: F.concat(F.lit("[^ev-"), ((first + k) % n + 1).cast("string"), F.lit("]"))), "")

    return F.concat(*pick[:4], pins(0), F.lit("\n\n"), *pick[4:], pins(1))


EVIDENCE_CHARS = 1200  # of each numbered body in a page's prompt


def evidence_block(anchor: Column, title: Column, body: Column) -> Column:
    """One section as the JSON list of a prompt's evidence, indented by two."""
    items = (("id", anchor), ("type", F.lit("text")), ("section", title), ("content", body))
    lines = [F.concat(F.lit(f'    "{k}": '), X.json_string(v)) for k, v in items]
    return F.concat(F.lit("[\n  {\n"), F.concat_ws(",\n", *lines), F.lit("\n  }\n]"))


def section_messages(system: str, template: str, anchor: Column, title: Column, body: Column) -> Column:
    """Messages that ask for the items of a section; ``{evidence_content}`` in the template becomes its evidence."""
    user = F.replace(F.lit(template), F.lit("{evidence_content}"), evidence_block(anchor, title, body))
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def numbered_evidence(evidence: DataFrame, most: int = EVIDENCE_CHARS) -> DataFrame:
    """slug, user: all evidence of a page (slug, ev_no, doc_id, section_title, body), numbered, each with the
    begin of its body. What is gathered is what one prompt holds."""
    body = squeezed(F.coalesce("body", F.lit("")))
    text = F.concat(F.lit("["), F.col("ev_no").cast("string"), F.lit("] "), F.coalesce("doc_id", F.lit("")), F.lit(" / "), F.coalesce("section_title", F.lit("")), F.lit("\n"), F.substring(body, 1, most))
    x = evidence.select("slug", F.struct("ev_no", text.alias("text")).alias("x")).groupBy("slug").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return x.select("slug", F.array_join(F.transform("x", lambda v: v["text"]), "\n\n").alias("user"))


def candidates(cited: DataFrame, least: int = 2) -> DataFrame:
    """key, domains, links of documents that pages of several domains cite (key, domain, category_path,
    slug); both lists are sorted. A page holds all its links, so what is gathered is one page."""
    rows = cited.select("key", "domain", F.concat_ws("/", "category_path", "slug").alias("link")).distinct()
    found = rows.groupBy("key").agg(F.array_sort(F.collect_set("domain")).alias("domains"), F.array_sort(F.collect_set("link")).alias("links"))
    return found.filter(F.size("domains") >= least)


def candidate_messages(found: DataFrame, system: str) -> Column:
    """Messages that ask what a shared source is about."""
    user = F.concat(F.lit("Shared source: "), "key", F.lit("\nConnected domains: "), F.array_join("domains", ", "), F.lit("\nReferenced by topics: "), F.array_join("links", ", "))
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def entity_pages(found: DataFrame, kind: str = "entity") -> DataFrame:
    """key, markdown of candidates (key, domains, links, summary): header, summary, links back."""
    head = frontmatter(F.col("key"), F.array(F.lit(kind)), F.col("key"), F.array("key"), kind, F.transform("domains", lambda d: F.concat(F.lit("domain/"), d)))
    links = F.transform("links", lambda x: F.concat(F.lit("- [["), x, F.lit("|"), F.substring_index(x, "/", -1), F.lit("]]")))
    text = F.concat(head, F.lit("\n\n# "), F.col("key"), F.lit("\n\n"), squeezed(F.col("summary")), F.lit("\n\n## Appears in\n\n"), F.array_join(links, "\n"), F.lit("\n"))
    return found.select("key", text.alias("markdown"))


def answers(prompts: DataFrame, recorded: DataFrame) -> DataFrame:
    """Prompts (prompt_hash, ...) with the recorded response of their hash, null where there is none."""
    return prompts.join(recorded.select("prompt_hash", "response").dropDuplicates(["prompt_hash"]), "prompt_hash", "left")


def missing(prompts: DataFrame, recorded: DataFrame) -> DataFrame:
    """Prompts without a recorded response, each hash once: what is to be asked elsewhere."""
    return prompts.join(recorded.select("prompt_hash").distinct(), "prompt_hash", "left_anti").dropDuplicates(["prompt_hash"])


def asked(prompts: DataFrame, client: Callable[[list[dict]], str], tries: int = 5, wait: float = 0.5) -> DataFrame:
    """Answers of a client (messages to text) for prompts (prompt_hash, messages); a prompt that fails
    ``tries`` times has no response and its error. Tries wait twice as long each time, from ``wait`` seconds
    on up to a minute; the client decides on addresses. Prompts of one task are asked one by one, so the number of
    tasks is that of calls at once."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h, messages in zip(b.prompt_hash, b.messages):
                error = None
                for k in range(tries):
                    if k and wait:
                        time.sleep(min(60.0, wait * 2 ** (k - 1)))
                    try:
                        out.append((h, client([dict(m) if not hasattr(m, "asDict") else m.asDict() for m in messages]), None))
                        break
                    except Exception as e:
                        error = repr(e)[:500]
                else:
                    out.append((h, None, error))
            yield pd.DataFrame(out, columns=["prompt_hash", "response", "error"])

    return prompts.select("prompt_hash", "messages").mapInPandas(of, "prompt_hash string, response string, error string")


def provider(spark: SparkSession, name: str | None = None) -> str:
    """Which kind of answers a run uses: the argument, else the session's setting, else offline."""
    name = name or spark.conf.get("strataframe.provider", None) or os.environ.get("STRATAFRAME_PROVIDER") or "offline"
    if name not in ("offline", "recorded", "client"):
        raise NotImplementedError(f"no provider {name!r}")
    return name


def pages(topics: DataFrame, evidence: DataFrame, responses: DataFrame, depth: int = 0) -> DataFrame:
    """slug, markdown, n_pins, n_unresolved of topics (slug, title) with evidence (slug, ev_no, doc_id,
    anchor, section_title, page_start) and responses (slug, body).

    Pins are led to their evidence by a join on the number, so only what is cited is gathered.
    """
    body = responses.select("slug", "body").withColumn("pin", F.explode_outer(F.array_sort(F.array_distinct(X.pins(F.col("body"))))))
    e = evidence.select("slug", F.col("ev_no").alias("pin"), "doc_id", "anchor", "section_title", "page_start")
    size = evidence.groupBy("slug").agg(F.max("ev_no").alias("n_evidence"))
    link = F.concat(F.lit("../" * depth + "../kb/"), F.col("doc_id"), F.lit("/main.md#"), F.col("anchor"))
    hint = F.when(F.col("page_start").isNotNull(), F.concat(F.lit(" (p."), F.col("page_start").cast("string"), F.lit(")"))).otherwise("")
    known = F.concat(F.lit("[^ev-"), F.col("pin").cast("string"), F.lit("]: ["), F.coalesce("section_title", F.lit("")), hint, F.lit("]("), link, F.lit(")"))
    unknown = F.concat(F.lit("[^ev-"), F.col("pin").cast("string"), F.lit("]: (UNRESOLVED — evidence index "), F.col("pin").cast("string"), F.lit(" out of range)"))
    notes = body.join(e, ["slug", "pin"], "left").withColumn("note", F.when(F.col("doc_id").isNotNull(), known).when(F.col("pin").isNotNull(), unknown))
    per = notes.groupBy("slug").agg(F.first("body").alias("body"), F.array_sort(F.collect_list(F.when(F.col("pin").isNotNull(), F.struct("pin", "note")))).alias("notes"), F.count("pin").alias("n_pins"), F.sum(F.when(F.col("pin").isNotNull() & F.col("doc_id").isNull(), 1).otherwise(0)).alias("n_unresolved"))
    p = topics.select("slug", "title").join(size, "slug").join(per, "slug")
    foot = F.array_join(F.transform("notes", lambda n: n["note"]), "\n")
    text = F.concat(F.lit("# "), "title", F.lit("\n\n> Slug: `"), "slug", F.lit("` · Evidence sources: "), F.col("n_evidence").cast("string"), F.lit("\n\n"), squeezed(F.col("body")), F.lit("\n"), F.when(F.col("n_pins") > 0, F.concat(F.lit("\n"), foot, F.lit("\n"))).otherwise(""))
    return p.select("slug", text.alias("markdown"), "n_pins", "n_unresolved")


def yaml_scalar(value: Column) -> Column:
    """A value of a page's header, in quotes only where it needs them."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when((value == "") | value.rlike(QUOTED) | (value != squeezed(value)), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(value)


def frontmatter(title: Column, path: Column, slug: Column, sources: Column, kind: str = "topic", more: Column | None = None) -> Column:
    """The header of a page: fixed order of keys, sorted lists. path: array of slugs, sources: array,
    more: array of further tags."""
    domain = F.coalesce(F.get(path, F.lit(0)), F.lit(UNCATEGORIZED))
    tags = F.array_sort(F.array_distinct(F.concat(F.array(F.concat(F.lit("domain/"), domain)), F.transform(path, lambda s: F.concat(F.lit("path/"), s)), *([] if more is None else [more]))))
    items = lambda a: F.concat(F.lit("\n"), F.array_join(F.transform(a, lambda x: F.concat(F.lit("  - "), yaml_scalar(x))), "\n"))
    where = F.coalesce(F.nullif(F.array_join(path, "/"), F.lit("")), domain)
    lines = [("title", yaml_scalar(title)), ("type", F.lit(kind)), ("domain", yaml_scalar(domain)), ("category_path", yaml_scalar(where)), ("slug", yaml_scalar(slug)), ("evidence_sources", items(F.array_sort(F.array_distinct(sources)))), ("tags", items(tags))]
    return F.concat(F.lit("---\n"), *(x for k, v in lines for x in (F.lit(f"{k}:" if k in ("evidence_sources", "tags") else f"{k}: "), v, F.lit("\n"))), F.lit("---"))


def verbatim(quote: Column, body: Column) -> Column:
    """The span of a body that a quote repeats but for white space; null if there is none."""
    words = F.filter(F.split(quote, r"(?U)\s+"), lambda w: w != "")
    pattern = F.array_join(F.transform(words, lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))), r"[\s 　]+")
    return F.when(F.size(words) > 0, F.regexp_substr(body, pattern))


def coerced_items(raw: DataFrame) -> DataFrame:
    """Test items as they may be stored: the category is the section's own, the reference its anchor,
    defaults fill what is missing, and a quote that isn't in the body is dropped.

    Takes anchor, section_title, section_category, body, and the untrusted what, how, sample_size,
    source_document, quote."""
    t = lambda c: squeezed(F.coalesce(F.col(c), F.lit("")))
    or_ = lambda c, d: F.coalesce(F.nullif(t(c), F.lit("")), F.lit(d))
    keep = [c for c in ("doc_id",) if c in raw.columns]
    return raw.select(*keep, or_("section_category", "Uncategorized").alias("category"), t("what").alias("what"), or_("how", DEFAULT_HOW).alias("how"), or_("sample_size", DEFAULT_SAMPLE).alias("sample_size"), or_("source_document", DEFAULT_DOC).alias("source_document"), F.col("section_title").alias("source_section"), F.col("anchor").alias("evidence_ref"), F.coalesce(verbatim(t("quote"), F.coalesce("body", F.lit(""))), F.lit("")).alias("evidence_quote"))


def is_logo(sha: Column, path: Column, alt: Column, shas: list[str], file_globs: list[str], alt_globs: list[str]) -> Column:
    """Whether an image is to be dropped: by its hash, its file's name or its text."""
    hit = sha.isin(shas) if shas else F.lit(False)
    name = F.lower(F.substring_index(path, "/", -1))
    for column, globs in ((name, file_globs), (F.lower(F.coalesce(alt, F.lit(""))), alt_globs)):
        for g in globs:
            hit = hit | column.rlike(_glob(g))
    return hit


def _glob(g: str) -> str:
    return fnmatch.translate(g.lower()).replace("(?s:", "(?s)(?:")


def without_lines(text: Column, paths: Column) -> Column:
    """Text without the lines that show one of the given assets."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~F.exists(paths, lambda p: F.contains(line, F.concat(F.lit("]("), p, F.lit(")"))))), "\n")


# Warnings that may be recorded.
WARNINGS = (
    r"^pdf\.scanned_no_text_layer$",
    r"^pdf\.scanned_page:p\d+$",
    r"^pdf\.password_protected$",
    r"^pdf\.low_confidence_heading:p\d+$",
    r"^pdf\.font_decode_failed:p\d+$",
    r"^docx\.unknown_style:[\w\- ().,]+$",
    r"^docx\.embedded_ole_skipped:[\w\-. ]+$",
    r"^xlsx\.formula_empty_cache:[^!]+![A-Z]+\d+$",
    r"^xlsx\.merged_cells_flattened:[^!]+![A-Z]+\d+:[A-Z]+\d+$",
    r"^pptx\.animation_ignored:slide\d+$",
    r"^image\.exif:[\w]+=[^\s]+$",
    r"^zip\.encrypted:[\w\-.]+$",
    r"^zip\.too_nested:depth=\d+$",
)


def unknown_warnings(warnings: DataFrame) -> DataFrame:
    """Warnings (warning, ...) that are on no list."""
    return warnings.filter(~F.col("warning").rlike("|".join(f"(?:{p})" for p in WARNINGS)))


def is_scanned(text: Column, least: int = 50) -> Column:
    """Whether a page has hardly any text of its own."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s", "")) < least


def log_entry(date: Column, kind: Column, topics: Column, pins: Column) -> Column:
    """One line of a build log."""
    return F.concat(F.lit("## ["), date, F.lit("] build | provider="), kind, F.lit(", topics="), topics.cast("string"), F.lit(", pins="), pins.cast("string"))
