"""Batch operators over keyed observations."""
