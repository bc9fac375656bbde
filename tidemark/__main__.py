"""``python -m tidemark list`` and ``python -m tidemark run NAME FOLDER [CSV]``."""

from __future__ import annotations

import sys

import tidemark.plans.catalogue  # noqa: F401
from tidemark import registry
from tidemark.session import build_session


def main(args: list[str]) -> int:
    if args[:1] == ["list"]:
        print("\n".join(sorted(registry.queries())))
        return 0
    if len(args) not in (3, 4) or args[0] != "run":
        print(__doc__, file=sys.stderr)
        return 2
    rows = registry.queries()[args[1]](build_session(), args[2])
    if len(args) == 4:
        rows.coalesce(1).write.mode("overwrite").csv(args[3], header=True)
    else:
        rows.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
