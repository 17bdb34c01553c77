"""DataFrame operators: tables, assembly, chunking, model exchange, usage, rates."""
