"""Writers: labelled batches, day partitions, messages, console."""
