"""Run the change feed as a job.

    python -m tidemark poll   --log PATH --tables a,b --offsets PATH --out PATH [--cycles N] [--poll-seconds S]
    python -m tidemark drain  --log PATH --tables a,b --offsets PATH --out PATH [--envelopes]
    python -m tidemark drain  --log PATH --tables a,b --out PATH --atomic
    python -m tidemark stream --log PATH --tables a,b --out PATH --checkpoint PATH [--offsets PATH]

``poll`` runs N poll cycles (0: without end), each at most one batch per table,
then offsets are saved; an idle poll waits like any other.  A cycle that fails
is logged and tried again from the same cursor; after ``--retries`` failures in
a row the job ends with status 1.  ``drain`` publishes the whole backlog
numbered into batches in one cycle; ``stream`` runs the file-stream feed over
all logs until no new files are left, strictly after the stream's frontier and
with that frontier saved as offsets at the end if ``--offsets`` is given; it may be
stopped at any point.  Job arguments replace
a configuration file; the fixed wait replaces poll backoff.
"""

from __future__ import annotations

import argparse
import logging
import sys
import time

from tidemark.operators.batching import BatchSizer
from tidemark.operators.histogram import PollBounds
from tidemark.operators.offsets import OffsetStore
from tidemark.schema import PREMIUM_MESSAGE_BYTES, STANDARD_MESSAGE_BYTES
from tidemark.plans.cycle import envelope_publisher, json_lines_publisher, run_committed_cycle, run_cycle
from tidemark.session import get_session
from tidemark.sources.commit_sink import CommittedFeed
from tidemark.sources.changelog import read_change_log


log = logging.getLogger(__name__)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("mode", choices=["poll", "drain", "stream"])
    ap.add_argument("--log", required=True, action="append", help="change log path (repeat for logs with other columns)")
    ap.add_argument("--tables", required=True, help="comma-separated table names")
    ap.add_argument("--out", required=True)
    ap.add_argument("--offsets")
    ap.add_argument("--checkpoint")
    ap.add_argument("--cycles", type=int, default=1, help="poll cycles; 0 polls without end")
    ap.add_argument("--poll-seconds", type=float, default=5.0, help="wait between poll cycles")
    ap.add_argument("--retries", type=int, default=3, help="failed cycles in a row that end the job")
    ap.add_argument("--tier", choices=["standard", "premium"], default="standard",
                    help="message budget: 256 KiB (standard) or 1 MiB (premium)")
    ap.add_argument("--max-message-bytes", type=int, help="overrides --tier")
    ap.add_argument("--buffer-factor", type=float, default=0.2)
    ap.add_argument("--sample-size", type=int, default=100)
    ap.add_argument("--resample-seconds", type=float, default=3600.0)
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--processing-time", help="e.g. '5 seconds'; default: drain available files and stop")
    ap.add_argument("--format", default="text", choices=["text", "parquet"], help="stream sink format")
    ap.add_argument("--atomic", action="store_true", help="poll and drain: lines and offsets in one commit in --out")
    ap.add_argument("--replay-delay", help="stream: drop changes that come again within this time, e.g. '2 hours'")
    ap.add_argument("--order-width", type=int, help="stream: publish each table in (lsn, seq) order, in slots of this many LSNs")
    ap.add_argument("--order-lag", type=int, default=1, help="stream: slots that wait for files read out of order")
    ap.add_argument("--envelopes", action="store_true", help="drain: publish batch envelopes instead of change lines")
    ap.add_argument("--server-name", default="localhost")
    ap.add_argument("--poll-interval", default="5s", help="recorded in envelope metadata")
    a = ap.parse_args(argv)
    logging.basicConfig(stream=sys.stderr, level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    tables = [t for t in a.tables.split(",") if t]
    spark = get_session("tidemark-job")

    if a.mode == "stream":
        if not a.checkpoint:
            ap.error("stream needs --checkpoint")
        if a.order_width and (a.offsets or a.replay_delay or a.format != "text"):
            ap.error("--order-width writes text from the checkpoint alone: no --offsets, --replay-delay or other --format")
        return _stream(spark, a, tables)

    if a.atomic:
        if a.offsets or a.envelopes:
            ap.error("--atomic keeps its offsets with the lines; it takes neither --offsets nor --envelopes")
    elif not a.offsets:
        ap.error(f"{a.mode} needs --offsets or --atomic")
    # opened anew for every cycle, so files and columns added meanwhile are seen
    logs = lambda: [read_change_log(spark, p, tables, merge_schema=True) for p in a.log]
    store = None if a.atomic else OffsetStore(spark, a.offsets)
    if a.envelopes and a.mode != "drain":
        ap.error("--envelopes needs drain mode")
    publish = envelope_publisher(a.out) if a.envelopes else json_lines_publisher(a.out)
    extra = dict(envelopes=True, server_name=a.server_name, poll_interval=a.poll_interval) if a.envelopes else {}
    budget = a.max_message_bytes or (PREMIUM_MESSAGE_BYTES if a.tier == "premium" else STANDARD_MESSAGE_BYTES)
    sizer = BatchSizer(a.sample_size, budget, a.buffer_factor, a.resample_seconds)
    if a.mode == "poll":
        extra["poll_bounds"] = PollBounds(spark, f"{(a.out if a.atomic else a.offsets).rstrip('/')}-histogram")
    done, failed = 0, 0
    while True:
        # a cycle is numbered by the offsets version it will save; a replayed cycle
        # writes into the same folder again (at-least-once)
        cycle_id = ((CommittedFeed(spark, a.out).latest_cycle() if a.atomic else store.latest_version()) or 0) + 1
        try:
            if a.atomic:
                r = run_committed_cycle(spark, logs(), tables, a.out, mode=a.mode, sizer=sizer, **extra)
            else:
                r = run_cycle(spark, logs(), tables, store, publish, cycle_id=cycle_id, mode=a.mode, sizer=sizer, **extra)
        except Exception:  # reading or saving failed: the cursor has not moved
            log.exception("cycle %s failed", cycle_id)
            r = None
        if r is not None and r.published:
            print(f"cycle {cycle_id}: published rows={r.rows} offsets_version={r.offsets_version}", file=sys.stderr)
            done, failed = done + 1, 0
            if a.mode == "drain" or done == a.cycles:
                return 0
        else:
            failed += 1
            if failed >= a.retries:
                log.error("giving up after %s failed cycles in a row", failed)
                return 1
        time.sleep(a.poll_seconds)


def _stream(spark, a, tables: list[str]) -> int:
    """All logs in one stream; strictly after the frontier and with saved offsets with ``--offsets``."""
    from tidemark.streaming.ordered import run_ordered_feed
    from tidemark.streaming.stream import run_feed

    if a.order_width:
        run_ordered_feed(
            spark, a.log, tables, a.out, a.checkpoint, a.order_width, a.order_lag,
            max_files_per_trigger=a.max_files_per_trigger, processing_time=a.processing_time,
        )
        return 0
    store = OffsetStore(spark, a.offsets) if a.offsets else None
    run_feed(
        spark, a.log, tables, a.out, a.checkpoint, store, a.format,
        a.max_files_per_trigger, a.processing_time, replay_delay=a.replay_delay,
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
