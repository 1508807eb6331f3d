"""geoloom.llm"""
