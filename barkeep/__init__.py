"""barkeep: an intraday OHLCV bar archive and its analytics on Spark.

Subpackages:
    functions   column expressions (session arithmetic, action classification)
    sources     bronze / silver / action-store I/O and driver-table fixtures
    operators   candles, merge, adjust, sessions, parse, checks
    plans       composite plans: board, ingest, publish, benchmark shapes
    streaming   incremental bronze -> silver merging
"""

__version__ = "0.1.0"

# The public surface, one import away.
from barkeep.functions.timecols import in_session, minute_of_day, session_date  # noqa: E402
from barkeep.operators.actions import (action_conflicts, action_counts, action_factors,  # noqa: E402
                                       adjust_bars, classify_actions, merge_actions,
                                       new_actions, normalise_actions)
from barkeep.operators.candles import fold_bars, resample, ticks_to_bars  # noqa: E402
from barkeep.operators.checks import assert_passed, check_summary, run_checks, verdicts  # noqa: E402
from barkeep.operators.merge import merge_bars  # noqa: E402
from barkeep.operators.parse import parse_events, parse_payload  # noqa: E402
from barkeep.operators.sessions import (bars_by_symbol_day, last_sessions, latest_bars,  # noqa: E402
                                        source_fallback)
from barkeep.plans.board import board  # noqa: E402
from barkeep.plans.ingest import (check_archive, ingest, publish_if_passed,  # noqa: E402
                                  rebuild_archive, rebuild_silver)
from barkeep.session import build_session  # noqa: E402
from barkeep.sources.actions import read_actions, read_action_feed, save_actions  # noqa: E402
from barkeep.sources.bronze import land_bronze, read_bronze, read_bronze_files  # noqa: E402
from barkeep.sources.silver import (available, load_bars, merge_into_silver,  # noqa: E402
                                    refresh_check_summary, register_views, session_bars,
                                    write_silver)
from barkeep.streaming.merge_stream import stream_merge  # noqa: E402
