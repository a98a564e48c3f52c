"""Command lines: `python -m scriptorium.cli classify|ingest|ingest-folder|inspect|query|followup|session ...`.

The embedder is the deterministic stand-in, of the table's vector width; a follow-up's plan is read from a JSON
file, as a planning model would reply.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators import filters, followup, fusion, ingest, models, retrieval, turns
from scriptorium.sources import state, store


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="scriptorium")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, does: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name, help=does)
        own.add_argument("--db-path", required=True, help="the chunk table's folder")
        own.add_argument("--embedding-dimensions", type=int, default=256)
        return own

    inspect = command("inspect", "show rows of the chunk table")
    inspect.add_argument("--paper-id")
    inspect.add_argument("--limit", type=int, default=5)

    def asked(query: argparse.ArgumentParser) -> argparse.ArgumentParser:
        query.add_argument("query")
        query.add_argument("--output-path", help="a file for the Markdown; else it is printed")
        search_flags(query)
        return query

    asked(command("query", "rank chunks for a question and write them as Markdown"))
    session = asked(command("session", "take one turn of a research session"))
    session.add_argument("--session-path", required=True, help="the folder of the session's snapshots")
    session.add_argument("--run-mode", choices=turns.RUN_MODES, default="continue")
    session.add_argument("--branch-id")
    session.add_argument("--branch-label")
    session.add_argument("--candidate-pool-k", type=int)
    session.add_argument("--claim-similarity-threshold", type=float, default=0.85)

    def windowed(own: argparse.ArgumentParser) -> argparse.ArgumentParser:
        own.add_argument("--min-words", type=int, default=200)
        own.add_argument("--overlap-words", type=int, default=50)
        return own

    classify = windowed(commands.add_parser("classify", help="print the labelled chunks of Markdown as TSV"))
    classify.add_argument("markdown_path")
    one = command("ingest", "put classified JSON into the chunk table")
    one.add_argument("--classified-json", required=True)
    one.add_argument("--marker-json", help="layout JSON, for the metadata")
    for flag in ("paper-id", "pdf-path"):
        one.add_argument(f"--{flag}")
    one.add_argument("--replace-existing", action="store_true")
    folder = windowed(command("ingest-folder", "put a folder of layout JSON into the chunk table"))
    folder.add_argument("layout_dir")
    folder.add_argument("--glob", default="*.json")
    folder.add_argument("--recursive", action="store_true")
    folder.add_argument("--keep-unresolved", action="store_true", help="take papers with unresolved labels too")
    folder.add_argument("--replace-existing", action="store_true")

    later = command("followup", "retrieve evidence for a plan")
    later.add_argument("--plan-path", required=True, help="a file with the plan's JSON")
    later.add_argument("--output-path")
    return top


def search_flags(query: argparse.ArgumentParser) -> None:
    query.add_argument("--retrieval-mode", choices=retrieval.MODES, default="full")
    for flag, default in (("retrieval-depth", 10), ("final-top-k", 15), ("batch-size", 5), ("rewrite-count", 2), ("rrf-k", 60), ("min-rrf-lists", 1)):
        query.add_argument(f"--{flag}", type=int, default=default)
    query.add_argument("--min-relevance-score", type=float)
    query.add_argument("--no-hyde", action="store_true")
    for flag, kind in (("paper-id", str), ("year", int), ("paper-title-contains", str), ("classification-label", str)):
        query.add_argument(f"--{flag}", type=kind)
    query.add_argument("--author", action="append", default=[], help="may be repeated")


def request(args: argparse.Namespace) -> retrieval.QueryRequest:
    """The query's settings from its flags."""
    own = filters.QueryFilters(paper_id=args.paper_id, year=args.year, paper_title_contains=args.paper_title_contains,
                               classification_label=args.classification_label, authors_any=args.author)
    return retrieval.QueryRequest(args.query, args.retrieval_mode, args.retrieval_depth, args.final_top_k, args.batch_size, args.rewrite_count,
                                  args.rrf_k, args.min_rrf_lists, args.min_relevance_score, getattr(args, "candidate_pool_k", None), hyde=not args.no_hyde, filters=own)


def query_markdown(chunks: DataFrame, wanted: retrieval.QueryRequest, embedder: models.Embedder) -> str:
    """The ranked chunks, at most final_top_k, as one Markdown text."""
    ranked = retrieval.run(chunks, wanted, embedder)
    return store.query_artifact(ranked, {"query": wanted.query, "retrieval_mode": wanted.mode, "final_top_k": str(wanted.final_top_k)}).first()["value"]


def followup_markdown(chunks: DataFrame, plan: followup.Plan, embedder: models.Embedder) -> str:
    """The plan's evidence, at most 12 chunks a call, as one Markdown text; says so where there is none."""
    evidence = followup.retrieve(chunks, plan, lambda text: embedder.embed([text])[0])
    best = evidence.groupBy("chunk_id").agg(F.min("call_index").alias("call_index"), F.max("rrf_score").alias("rrf_score"),
                                            F.array_sort(F.array_distinct(F.flatten(F.collect_list("retrieval_keys")))).alias("retrieval_keys"))
    rows = fusion.batches(best.join(chunks, "chunk_id"), 5, "call_index", F.desc("rrf_score"), "chunk_id")
    head = {"intent": plan.intent, "answer_mode": plan.answer_mode, "reason": plan.reason, "calls": str(len(plan.tool_calls))}
    return store.query_artifact(rows, head).first()["value"]


def session_markdown(spark: SparkSession, chunks: DataFrame, args: argparse.Namespace, embedder: models.Embedder) -> str:
    """One turn, saved as the session's next snapshot, as Markdown."""
    disk = state.SessionStore(spark, args.session_path)
    now = turns.now_utc()
    before = disk.load() if disk.exists() else state.initial(spark, Path(args.session_path).stem, args.query, now)
    wanted = turns.TurnRequest(args.query, args.run_mode, args.branch_id, args.branch_label, request(args), args.claim_similarity_threshold)
    turn = turns.run(chunks, before, wanted, embedder, now=now)
    disk.save(turn.session)
    return turns.artifact(turn, args.session_path)


def ingest_rows(spark: SparkSession, args: argparse.Namespace, table: store.ChunkTable) -> str:
    """Ingest as the flags say; a report of key=value lines."""
    report = {}
    if args.command == "ingest":
        rows = ingest.from_classified(spark, args.classified_json, args.embedding_dimensions, args.marker_json, args.paper_id, args.pdf_path)
    else:
        layout = store.read_layout(spark, args.layout_dir, args.glob, args.recursive)
        done = ingest.from_layout(layout, args.embedding_dimensions, args.min_words, args.overlap_words, keep_unresolved=args.keep_unresolved)
        rows = done.rows
        report = {"papers_kept_back": 0 if args.keep_unresolved else done.kept_back.count(), "papers_with_issues": done.issues.count()}
    report = {"chunks": rows.count(), **report}
    (table.upsert if args.replace_existing else table.append)(rows)
    return "".join(f"{k}={v}\n" for k, v in report.items())


def classified_tsv(spark: SparkSession, path: str, min_words: int, overlap: int) -> str:
    """Totals and a line for each chunk of one Markdown file."""
    chunks = ingest.classified_chunks(store.read_markdown(spark, path), min_words, overlap)
    totals = chunks.agg(F.count("*").alias("n"), F.count_if(F.col("source") == "llm").alias("llm")).first()
    lines = ingest.tsv(chunks).orderBy("paper_id", "section_pos", "chunk_index").select("value").toLocalIterator()
    return "\n".join([f"total_chunks={totals['n']}", f"llm_classified_chunks={totals['llm']}", *(r["value"] for r in lines)]) + "\n"


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("scriptorium").getOrCreate()
    if args.command == "classify":
        sys.stdout.write(classified_tsv(spark, args.markdown_path, args.min_words, args.overlap_words))
        return
    table = store.ChunkTable(spark, args.db_path, args.embedding_dimensions)
    if args.command == "inspect":
        table.inspect(args.paper_id, args.limit).show(truncate=False)
        return
    if args.command.startswith("ingest"):
        sys.stdout.write(ingest_rows(spark, args, table))
        return
    embedder = models.HashEmbedder(args.embedding_dimensions)
    if args.command == "query":
        text = query_markdown(table.read(), request(args), embedder)
    elif args.command == "session":
        text = session_markdown(spark, table.read(), args, embedder)
    else:
        text = followup_markdown(table.read(), followup.parse_plan(Path(args.plan_path).read_text(encoding="utf-8")), embedder)
    if args.output_path:
        Path(args.output_path).write_text(text, encoding="utf-8")
    else:
        sys.stdout.write(text)


if __name__ == "__main__":
    main()
