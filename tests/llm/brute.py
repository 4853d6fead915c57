"""Brute-force versions of the operators, in plain Python, row by row."""

import collections
import hashlib
import re

import pyarrow.parquet as pq

def docs(sf): 
    t=pq.read_table(f'/root/testdata/{sf}/documents.parquet'); return dict(zip(t['doc_id'].to_pylist(),t['text'].to_pylist()))
def sha(s): return hashlib.sha256(s.encode()).hexdigest()
def op1(D):
    import tiktoken, base64, public_tokenizers as P
    R={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    e=tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=R, special_tokens={})
    o={}
    for i,t in D.items():
        x=e.encode_ordinary(t or ""); o[i]=(i,len(x),sha(" ".join(map(str,x))),sha(t or ""))
    return o
def op3(D):
    g=collections.defaultdict(list); n={}
    for i,t in D.items():
        n[i]=re.sub(r'[\x20\x09-\x0D]','',t or ""); g[n[i]].append(i)
    o={}
    for k,m in g.items():
        b=min(m,key=lambda i:(-len(D[i] or ""),i))
        for i in m: o[i]=(i,b,len(m),i==b,sha(k))
    return o
def op9(D,items):
    W=re.compile(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'); low=lambda s: re.sub('[A-Z]',lambda m:m.group().lower(),s or "")
    pats=collections.defaultdict(set)
    for i,t in items.items():
        w=W.findall(low(t)); n=min(10,len(w))
        if n:
            for k in range(len(w)-n+1): pats[tuple(w[k:k+n])].add(i)
    sizes={len(p) for p in pats}; o={}
    for i,t in D.items():
        w=W.findall(low(t)); hit=set(); it=set()
        for n in sizes:
            for k in range(len(w)-n+1):
                p=pats.get(tuple(w[k:k+n]))
                if p: hit.update(range(k,k+n)); it|=p
        o[i]=(i,len(w),len(hit),len(it),sha(",".join(sorted(map(str,it)))),bool(hit))
    return o
def op10(D):
    low=lambda s: re.sub('[A-Z]',lambda m:m.group().lower(),s or "")
    S={}
    for i,t in D.items():
        w=re.findall(r'[^\x20\x09-\x0D]+',low(t)); n=min(5,len(w))
        S[i]={tuple(w[k:k+n]) for k in range(len(w)-n+1)} if n else set()
    inv=collections.defaultdict(list); P=collections.Counter()
    for i,s in S.items():
        for x in s: inv[x].append(i)
    for m in inv.values():
        for a in range(len(m)):
            for b in range(a): P[(m[b],m[a])]+=1
    par={i:i for i in D}
    def f(x):
        while par[x]!=x: x=par[x]
        return x
    for (a,b),n in P.items():
        if 100*n>=75*(len(S[a])+len(S[b])-n):
            a,b=f(a),f(b); par[max(a,b)]=min(a,b)
    return {i:(i,len(S[i]),f(i),f(i)==i) for i in D}
def op4(D):
    S=re.compile(r'[^\x20\x09-\x0D]+'); W={i:S.findall(t or "") for i,t in D.items()}
    C=collections.Counter(tuple(w[k:k+35]) for w in W.values() for k in range(len(w)-34)); o={}
    for i,w in W.items():
        hit=set()
        for k in range(len(w)-34):
            if C[tuple(w[k:k+35])]>1: hit.update(range(k,k+35))
        kept=[x for k,x in enumerate(w) if k not in hit]
        o[i]=(i,len(w),len(w)-len(kept),sha(" ".join(kept)))
    return o
def op5(D):
    def fold(l): return l.strip(' \t\n\x0b\x0c\r')
    first={}; docs={}
    for i in sorted(D):
        ls=(D[i] or "").split("\n"); docs[i]=ls
        for n,l in enumerate(ls):
            f=fold(l)
            if f: first.setdefault(f,(i,n))
    V=collections.defaultdict(list)
    for f,at in first.items():
        w=f.split(" ")
        if len(w)>=5:
            V[(tuple(w))].append((at,f))
            for k in range(len(w)): V[tuple(w[:k]+w[k+1:])].append((at,f))
    def near(x,y):
        if len(x)==len(y): return sum(a!=b for a,b in zip(x,y))<=1
        if len(x)>len(y): x,y=y,x
        return len(y)-len(x)==1 and any(y[:k]+y[k+1:]==x for k in range(len(y)))
    gone=set()
    for m in V.values():
        m=sorted(set(m))
        for a in range(len(m)):
            for b in range(a):
                if m[a][0] not in gone and near(m[a][1].split(" "),m[b][1].split(" ")): gone.add(m[a][0])
    o={}
    for i,ls in docs.items():
        kept=[];eq=nr=0
        for n,l in enumerate(ls):
            f=fold(l)
            if f and first[f]!=(i,n): eq+=1
            elif f and (i,n) in gone: nr+=1
            else: kept.append(l)
        o[i]=(i,len(ls),eq,nr,sha("\n".join(kept)))
    return o
