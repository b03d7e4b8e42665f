"""Topics for posts as they are published."""
