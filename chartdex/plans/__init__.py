"""Complete jobs and the views they are checked on."""
