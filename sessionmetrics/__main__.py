"""``python -m sessionmetrics {job,report,ingest} [args]``."""

from __future__ import annotations

import sys


def main(argv=None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    commands = ("job", "report", "ingest")
    if not argv or argv[0] not in commands:
        raise SystemExit(f"usage: python -m sessionmetrics {{{','.join(commands)}}} [args]")
    command, rest = argv[0], argv[1:]
    if command == "job":
        from .plans.job import main as run
    elif command == "report":
        from .plans.report import main as run
    else:
        from .streaming.ingest import main as run
    run(rest)


if __name__ == "__main__":
    main()
