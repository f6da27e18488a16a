"""Command line: ``python -m folioflow plan|query|list|ask|serve``."""

from __future__ import annotations

import argparse

from folioflow.session import local_session, table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="folioflow")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the registered queries")
    run = commands.add_parser("query", help="run a registered query over a folder of tables")
    run.add_argument("name")
    run.add_argument("folder")
    run.add_argument("--out", help="write Parquet there instead of showing rows")
    plan = commands.add_parser("plan", help="stages to run for each current version")
    plan.add_argument("folder")
    plan.add_argument("--to-stage")
    start = plan.add_mutually_exclusive_group()
    start.add_argument("--from-stage", help="only versions that go on from this stage or a later one")
    start.add_argument("--only-stage", help="only versions whose next stage is this one")
    start.add_argument("--force-stage", help="all versions that have come as far go on from this stage")
    start.add_argument("--force-all", action="store_true", help="all versions from the first stage")
    plan.add_argument("--file-path", action="append", default=[])
    plan.add_argument("--glob", action="append", default=[])
    ask = commands.add_parser("ask", help="evidence for a question")
    ask.add_argument("folder")
    asked = ask.add_mutually_exclusive_group(required=True)
    asked.add_argument("--query")
    asked.add_argument("--test", help="a suite of test questions")
    ask.add_argument("--bank", action="append", default=[])
    ask.add_argument("--period", action="append", default=[])
    ask.add_argument("--source", action="append", default=[])
    serve = commands.add_parser("serve", help="the engine over HTTP on this machine")
    serve.add_argument("folder")
    serve.add_argument("--traces", required=True)
    serve.add_argument("--suite")
    serve.add_argument("--port", type=int, default=8080)
    args = parser.parse_args(argv)
    from folioflow.plans import registry

    if args.command == "list":
        print("\n".join(sorted(registry.queries())))
        return
    spark = local_session()
    if args.command == "query":
        out = registry.queries()[args.name](spark, args.folder)
        out.write.mode("overwrite").parquet(args.out) if args.out else out.show(50, truncate=80)
        return
    from pyspark.sql import functions as F

    from folioflow import engine
    from folioflow.operators import planning

    versions = table(spark, args.folder, "document_versions")
    if args.command == "plan":
        chosen = versions.where(planning.selected(args.file_path, args.glob))
        plans = planning.resume_plans(chosen, table(spark, args.folder, "stage_checkpoints"), table(spark, args.folder, "stage_signatures"))
        if args.force_all or args.force_stage:
            plans = planning.forced(plans, args.force_stage)
        wanted = planning.stage_range(args.only_stage or args.from_stage, args.only_stage or args.to_stage)
        plans.where(F.col("start_stage").isin(*wanted) | F.col("start_stage").isNull()).show(50, truncate=False)
        return
    if args.command == "serve":
        from folioflow.service import server

        server(spark, args.folder, args.traces, args.suite, args.port).serve_forever()
        return
    for column, values in (("filter_2", args.bank), ("filter_1", args.period), ("data_source", args.source)):
        if values:
            versions = versions.where(F.col(column).isin(*values))
    pages = table(spark, args.folder, "page_results").join(versions.where("is_current").select(F.col("id").alias("document_version_id")), "document_version_id", "left_semi")
    if args.test:
        from folioflow.sources.exchange import query_suite

        questions = query_suite(spark, args.test).select(F.col("name").alias("query_id"), F.col("query").alias("text"))
    else:
        questions = spark.createDataFrame([(1, args.query)], "query_id int, text string")
    engine.retrieve(pages, questions).orderBy("query_id", F.col("score").desc()).show(50, truncate=80)


if __name__ == "__main__":
    main()
