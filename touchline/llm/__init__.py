"""Training-data operators: filtering, de-duplication, tokens, packing, sharding, chat."""
