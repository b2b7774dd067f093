"""Jobs from the command line: ``python -m corpusmill <job> --name value …``.

Each job is a function of ``corpusmill.plans.jobs``; its parameters are the options.
"""

from __future__ import annotations

import argparse
import inspect

from corpusmill.plans import jobs
from corpusmill.session import build_session

JOBS = (
    jobs.curate_crawl,
    jobs.choose_urls,
    jobs.create_dataset,
    jobs.shuffle_dataset,
    jobs.train_model,
    jobs.tokenize_corpus,
)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="corpusmill")
    commands = root.add_subparsers(dest="job", required=True)
    for job in JOBS:
        command = commands.add_parser(job.__name__.replace("_", "-"), help=inspect.getdoc(job))
        command.set_defaults(run=job)
        for name, parameter in list(inspect.signature(job).parameters.items())[1:]:
            needed = parameter.default is inspect.Parameter.empty
            whole = "int" in str(parameter.annotation)
            command.add_argument(
                f"--{name.replace('_', '-')}",
                dest=name,
                required=needed,
                default=None if needed else parameter.default,
                type=int if whole else str,
            )
    return root


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    job, run = options.pop("job"), options.pop("run")
    result = run(build_session(f"corpusmill {job}"), **options)
    if result is not None:
        result.show(100, truncate=False)


if __name__ == "__main__":
    main()
