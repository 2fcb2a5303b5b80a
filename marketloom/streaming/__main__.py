"""``python -m marketloom.streaming <layer>``: run one layer with settings from the environment."""

from __future__ import annotations

import os
import sys

from marketloom.config import Settings
from marketloom.session import build_session
from marketloom.streaming.layers import LAYERS, run_layer


def main(arguments: list[str]) -> int:
    if len(arguments) != 1 or arguments[0] not in LAYERS:
        print(f"usage: python -m marketloom.streaming {{{'|'.join(LAYERS)}}}", file=sys.stderr)
        return 2
    layer = arguments[0]
    # The alert publishers share one set of pacing variables.
    settings = Settings.from_env(os.environ, layer="alert" if "alerts" in layer else layer)
    spark = build_session(f"market-{layer}")
    try:
        run_layer(spark, settings, LAYERS[layer])
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
