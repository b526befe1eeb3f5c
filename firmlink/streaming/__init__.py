"""Incremental loads with Structured Streaming.

The jobs are batch jobs; repeated loads are safe because staging is
insert-if-absent. The same property makes a streaming form exact: each
micro-batch is staged against the target table, so a replayed batch (after
a failure) inserts nothing twice.
"""

from firmlink.streaming.incremental import crawl_hits_stream, registry_xml_stream

__all__ = ["crawl_hits_stream", "registry_xml_stream"]
