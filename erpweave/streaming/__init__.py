"""Incremental runs of the unification operators with Structured Streaming."""

from erpweave.streaming.micro_batch import current_orders, run_micro_batches, run_order_batches, stream_process_orders

__all__ = ["current_orders", "run_micro_batches", "run_order_batches", "stream_process_orders"]
