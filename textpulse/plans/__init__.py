"""End-to-end plans composed of the operators, for batches and streams alike."""
