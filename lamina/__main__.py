"""python -m lamina compile FILE --text-only | --answers PATH; compile-library FOLDER ...; verify FOLDER. Exit code 1 with a JSON error on failure."""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lamina")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("compile", "compile-library"):
        c = sub.add_parser(name)
        c.add_argument("source")
        c.add_argument("--target", default="packages")
        how = c.add_mutually_exclusive_group(required=True)
        how.add_argument("--text-only", action="store_true")
        how.add_argument("--answers", help="Parquet of doc_id, batch_index, raw_text")
        how.add_argument("--llm", action="store_true", help="ask the endpoint of --provider, --url, --model (or LAMINA_* variables)")
        for option in ("--provider", "--url", "--model", "--api-key"):
            c.add_argument(option)
        c.add_argument("--max-tokens", type=int)
        c.add_argument("--json", action="store_true", help="print the summary as JSON on one line")
        c.add_argument("--attempts", type=int, default=2)
        c.add_argument("--protocol", choices=("compact", "verbose"), default="compact")
        c.add_argument("--keep-going", action="store_true", help="emit although violations are left")
    v = sub.add_parser("verify")
    v.add_argument("folder")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from .operators import candidates as ca
    from .operators.validate import stop_on_errors
    from .plans import compile as co
    from .plans import extract
    from .runtime import cut, session
    from .sources import model, texts

    spark = session()
    try:
        if args.command == "verify":
            found = co.verify(spark, args.folder)
            bad = found.where("value <> case check when 'resolved_rate' then 1.0 else 0.0 end")
            worst = {f"{r.package}/{r.check}": r.value for r in bad.orderBy("package", "check").limit(20).collect()}
            print(json.dumps({"packages": found.select("package").distinct().count(), "bad": worst}, sort_keys=True))
            return int(bool(worst))
        source = texts.read_files(spark, args.source) if args.command == "compile" else texts.read_library(spark, args.source)
        answers = spark.read.parquet(args.answers) if args.answers else None
        if args.llm:
            given = {"url": args.url, "model": args.model, "api_key": args.api_key, "max_tokens": args.max_tokens}
            client = model.http_client(model.Endpoint.resolve(args.provider, **{k: v for k, v in given.items() if v is not None}))
            segments = co.text_only(source)["Segment"]
            parts = cut(ca.batches(segments), "batches")
            answers, _ = extract.chapters(segments, parts, client, hints=extract.scan(segments, parts, client))
        tables = co.compile_texts(source, answers, args.attempts, args.protocol)
        if "Violation" in tables and not args.keep_going:
            stop_on_errors(tables["Violation"])
        co.stop_on_failed(co.emit(tables, args.target))
        said = co.summary(tables)
        print(said if args.json else json.dumps(json.loads(said), indent=2, sort_keys=True))
        return 0
    except Exception as e:
        print(json.dumps({"error": f"{type(e).__name__}: {str(e)[:500]}"}))
        return 1


if __name__ == "__main__":
    sys.exit(main())
