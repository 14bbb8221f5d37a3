"""DataFrame operators: positions, resources, responses, trees, typed rows."""
