"""Tables in and out: adapters, keyed merges, exports, paged sources."""
