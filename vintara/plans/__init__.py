"""Selection policy and multi-step results."""
