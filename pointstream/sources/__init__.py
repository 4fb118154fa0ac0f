"""Readers: captured datagrams, message streams, dimensions, ledgers, generated ids."""
