"""Runs the job: ``spark-submit ... -m tidemark job.json`` or with python -m.

The file holds the members of ``streaming.job.JobConfig``.
"""

from __future__ import annotations

import json
import sys

from tidemark.session import build_session
from tidemark.streaming.job import JobConfig, run_job


def main(path: str) -> None:
    with open(path, encoding="utf-8") as file:
        config = JobConfig(**json.load(file))
    run_job(build_session(config.name, parallelism=config.parallelism), config)


if __name__ == "__main__":
    main(sys.argv[1])
