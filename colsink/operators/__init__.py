"""Work on column buffers and batches."""
