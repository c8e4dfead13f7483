from namelens.streaming.queues import EVERY_10_SECONDS, ONCE, start_ingest, start_queue

__all__ = ["EVERY_10_SECONDS", "ONCE", "start_ingest", "start_queue"]
