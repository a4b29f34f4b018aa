from ledgerline.streaming.landing_stream import landing_stream, run_stream

__all__ = ["landing_stream", "run_stream"]
