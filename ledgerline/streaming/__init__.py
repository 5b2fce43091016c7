"""ledgerline.streaming"""
